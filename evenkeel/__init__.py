"""Balanced binary classification on wide tables, as Spark jobs."""

from evenkeel.spec import Block, FeatureSpec, family

__all__ = ["Block", "FeatureSpec", "family"]
