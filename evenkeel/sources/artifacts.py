"""Fitted models on storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import SparkSession

from evenkeel.sources.published import current, publish


def save_model(model: PipelineModel | LogisticRegressionModel, path: str) -> None:
    """Publishes the model: one saved there before stays whole until the new one is."""
    publish(SparkSession.active(), path, lambda folder: model.write().save(folder))


def load_feature_model(path: str) -> PipelineModel:
    return PipelineModel.load(current(SparkSession.active(), path))


def load_classifier(path: str) -> LogisticRegressionModel:
    """The classifier without its training summary, which is never saved."""
    return LogisticRegressionModel.load(current(SparkSession.active(), path))
