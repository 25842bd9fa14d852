"""Fitting, evaluating and applying the classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import (
    BinaryLogisticRegressionTrainingSummary,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.scalars import vector_element
from evenkeel.operators.balance import SEED, ClassBalance, balance_classes, fold_rows, shuffle_rows
from evenkeel.operators.metrics import metrics_report
from evenkeel.operators.roc import bounded_curve, roc_curve
from evenkeel.staging import stage

# Settings of the published fit.
ITERATIONS = 10
REGULARISATION = 0.0
ELASTIC_NET = 0.0
THRESHOLD = 0.5

PREDICTION = "predictions"


@dataclass(frozen=True)
class Fit:
    """A classifier, the balanced rows it was fitted on (a written table) and the class sizes before balancing."""

    model: LogisticRegressionModel
    rows: DataFrame
    sizes: ClassBalance

    def sizes_report(self) -> DataFrame:
        """``(metric, label, value)``: rows of either class, and rows left out for want of a label."""
        found = [
            ("rows", 1.0, self.sizes.positives),
            ("rows", 0.0, self.sizes.negatives),
            ("rows", None, self.sizes.unlabelled),
        ]
        values = [(m, v, float(n)) for m, v, n in found]
        return self.rows.sparkSession.createDataFrame(values, "metric string, label double, value double")


def fit_classifier(features: DataFrame, label: str, key: str, **options) -> LogisticRegressionModel:
    """The model alone; options as for ``fit_balanced``."""
    return fit_balanced(features, label, key, **options).model


def fit_balanced(
    features: DataFrame,
    label: str,
    key: str,
    mode: str = "replicate",
    seed: int = SEED,
    shuffle: bool = False,
    partitions: int | None = None,
    max_iter: int = ITERATIONS,
    reg_param: float = REGULARISATION,
    elastic_net: float = ELASTIC_NET,
    threshold: float = THRESHOLD,
    tolerance: float = 1e-6,
    tree_depth: int = 2,
    allow_undersampling: bool = False,
    stage_rows: bool = True,
    fold: bool = False,
) -> Fit:
    """Balance the classes and fit a binary logistic regression.

    Every iteration reads all rows, so their order does not matter; ``shuffle`` sorts
    them randomly all the same. ``tree_depth`` above 2 adds levels when gradients of
    very wide features from many partitions are summed. The features are written once, as counting, balancing and
    fitting read them (turn ``stage_rows`` off for a written table), and cached by the fit, on disk where memory is short. The model carries its training summary.

    ``fold`` adds up balanced rows that are equal in features and label before the fit, so that an iteration reads each of
    them once. Where a fit without a penalty converges, the weights are the same; with a penalty, or after a fixed number
    of iterations, they differ slightly, as Spark scales features by a variance that depends on how weight is spread over rows.
    """
    written = stage(features.select(key, "features", label), "features") if stage_rows else features
    rows, sizes = balance_classes(written, label, key, mode, seed, allow_undersampling)
    if shuffle:
        rows = shuffle_rows(rows, seed, partitions)
    elif partitions is not None:
        rows = rows.coalesce(partitions)
    regression = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        predictionCol=PREDICTION,
        maxIter=max_iter,
        regParam=reg_param,
        elasticNetParam=elastic_net,
        threshold=threshold,
        tol=tolerance,
        aggregationDepth=tree_depth,
    )
    if mode == "weight" or fold:
        regression = regression.setWeightCol("weight")
    fitted_on = rows
    if fold:
        fitted_on = stage(fold_rows(rows, label, weight="weight" if mode == "weight" else None), "folded")
    return Fit(regression.fit(fitted_on), rows, sizes)


def summary_report(summary: BinaryLogisticRegressionTrainingSummary, df: DataFrame) -> DataFrame:
    """``(metric, label, value)`` from a model summary; its area is taken from a curve of about 1000 points."""
    labels = [float(v) for v in summary.labels]
    by_label = {
        "precision": summary.precisionByLabel,
        "recall": summary.recallByLabel,
        "false_positive_rate": summary.falsePositiveRateByLabel,
        "true_positive_rate": summary.truePositiveRateByLabel,
    }
    rows = [("label", v, v) for v in labels]
    rows += [(name, v, float(x)) for name, values in by_label.items() for v, x in zip(labels, values, strict=True)]
    rows += [("accuracy", None, float(summary.accuracy)), ("area_under_roc", None, float(summary.areaUnderROC))]
    return df.sparkSession.createDataFrame(rows, "metric string, label double, value double")


def score(model: LogisticRegressionModel, features: DataFrame) -> DataFrame:
    """All columns plus ``rawPrediction``, ``probability`` and ``predictions``."""
    return model.transform(features)


def evaluate(model: LogisticRegressionModel, features: DataFrame, label: str) -> DataFrame:
    """``(metric, label, value)`` on any labelled rows, with the exact area under the curve."""
    scored = score(model, features.where(F.col(label).isNotNull()))
    return metrics_report(
        scored.select(label, PREDICTION, vector_element("probability", 1).alias("score")), label, PREDICTION, "score"
    )


def exact_curve(model: LogisticRegressionModel, features: DataFrame, label: str) -> DataFrame:
    """``(FPR, TPR)`` with a point for every distinct score, however many there are. Weighted rows count by weight."""
    scored = score(model, features.where(F.col(label).isNotNull()))
    weight = F.col("weight") if "weight" in features.columns else None
    return roc_curve(scored.withColumn("_score", vector_element("probability", 1)), label, "_score", weight)


def thinned_curve(model: LogisticRegressionModel, features: DataFrame, label: str, points: int) -> DataFrame:
    """``(FPR, TPR, bound)``: as ``exact_curve``, with at most so many points and what each step may be off."""
    scored = score(model, features.where(F.col(label).isNotNull()))
    weight = F.col("weight") if "weight" in features.columns else None
    return bounded_curve(scored.withColumn("_score", vector_element("probability", 1)), label, "_score", points, weight)


def unpack_probability(scored: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """The key and one column per class probability."""
    probability = vector_to_array(F.col("probability"))
    return scored.select(key, *[probability[i].alias(name) for i, name in enumerate(names)])


def submission(model: LogisticRegressionModel, features: DataFrame, key: str, label: str) -> DataFrame:
    """``(key, label)`` where the label column holds the probability of class 1."""
    return unpack_probability(score(model, features), key, (f"not_{label}", label)).select(key, label)
