"""All registered queries."""

from corpusmill.plans import bayes_queries, corpus_queries, feature_queries, metric_queries, model_queries  # noqa: F401
from corpusmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
