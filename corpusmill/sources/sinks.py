"""Feature tables, label files, metric records, prediction reports."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.config import FeatureConfig

FEATURE_SCHEMA = "doc_id long, label int, idx array<int>, val array<double>, split string, scaled boolean"


def write_labels(docs: DataFrame, path: str) -> None:
    docs.select("doc_id", "label").write.option("header", True).csv(path)


def write_features(rows: DataFrame, path: str, scaled: bool, mode: str = "append") -> None:
    """``rows`` (doc_id, label, split, idx, val); side and form become folders."""
    (rows.withColumn("scaled", F.lit(scaled)).write.mode(mode)
     .partitionBy("scaled", "split").parquet(path))


def read_features(spark: SparkSession, path: str, scaled: bool, split: str | None = None) -> DataFrame:
    """Only the folders of the asked form and side are listed and read."""
    df = spark.read.schema(FEATURE_SCHEMA).parquet(path).where(F.col("scaled") == scaled)
    return df if split is None else df.where(F.col("split") == split)


def write_run_metadata(spark: SparkSession, path: str, config: FeatureConfig, stats: DataFrame) -> None:
    """config, split_info and per-side stats as JSON records."""
    spark.createDataFrame([(json.dumps(asdict(config)),)], "config string").write.json(f"{path}/config")
    sides = stats.groupBy().agg(
        F.sum(F.when(F.col("split") == "train", F.col("n_samples"))).alias("n_train"),
        F.sum(F.when(F.col("split") == "test", F.col("n_samples"))).alias("n_test"))
    sides.select(F.lit(config.random_state).alias("random_state"), F.lit(config.test_size).alias("test_size"),
                 "n_train", "n_test", F.lit(True).alias("stratified")).write.json(f"{path}/split_info")
    stats.write.json(f"{path}/stats")


def write_metrics(metrics: DataFrame, path: str, **extra) -> None:
    """Metric record(s) as JSON with run fields such as a test name or seconds."""
    metrics.withColumns({k: F.lit(v) for k, v in extra.items()}).write.json(path)


def write_predictions(report: DataFrame, path: str) -> None:
    report.write.option("header", True).option("escape", '"').csv(path)


def report_lines(report: DataFrame) -> DataFrame:
    """The classification report as aligned text lines (a handful of rows)."""
    order = F.array_position(F.array(*[F.lit(x) for x in (
        "class_0", "class_1", "accuracy", "macro_avg", "weighted_avg")]), F.col("row"))
    return report.orderBy(order).select(F.format_string(
        "%-14s %9.4f %9.4f %9.4f %9d", "row", "precision", "recall", "f1_score", "support").alias("value"))


def summary_lines(one_row: DataFrame, title: str) -> DataFrame:
    """'name: value' lines of a one-row profile under a heading."""
    lines = [F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in one_row.columns]
    return one_row.select(F.explode(F.array(F.lit(f"=== {title} ==="), *lines)).alias("value"))


def text_report(lines: DataFrame, path: str) -> None:
    """Lines in one file; a report has tens of rows."""
    lines.coalesce(1).write.text(path)
