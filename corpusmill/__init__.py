"""Labelled-text analytics as Spark DataFrame operators."""

from corpusmill.config import FeatureConfig

__all__ = ["FeatureConfig"]
