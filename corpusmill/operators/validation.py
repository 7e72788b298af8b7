"""Readiness checks of built features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def validate_features(docs: DataFrame, weights: DataFrame, n_features: int | None = None) -> DataFrame:
    """(check, passed) rows from one pass over either input.

    ``docs`` (doc_id, split, label); ``weights`` (doc_id, split, term_idx, weight).
    """
    w = F.col("weight")
    wide = [] if n_features is None else [
        (F.coalesce(F.max("term_idx"), F.lit(-1)) < n_features).alias("width_within_vocabulary")]
    finite = ~(F.isnan(w) | (F.abs(w) == F.lit(float("inf"))) | w.isNull())
    by_weights = weights.agg(
        F.coalesce(F.min(finite.cast("int")) == 1, F.lit(True)).alias("all_finite"),
        (F.count(F.when(F.col("split") == "train", 1)) > 0).alias("train_not_empty"),
        (F.count(F.when(F.col("split") == "test", 1)) > 0).alias("test_not_empty"), *wide)
    by_docs = docs.agg(
        (F.count("*") == F.count("label")).alias("rows_match_labels"),
        F.coalesce(F.min(F.col("label").isin(0, 1).cast("int")) == 1, F.lit(True)).alias("labels_binary"))

    def long(one):
        return one.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("check"), F.col(c).alias("passed")) for c in one.columns])))

    return long(by_docs).unionByName(long(by_weights))


def distinct_labels(docs: DataFrame) -> DataFrame:
    return docs.groupBy("label").agg(F.lit(1).alias("_o")).select(
        "label", F.col("label").isin(0, 1).alias("valid"))
