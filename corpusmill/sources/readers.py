"""Corpus readers: per-class CSV pairs, an external corpus, batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusmill.operators.corpus import fill_missing, union_classes
from corpusmill.session import materialize

ARTICLE = "title string, text string, subject string, date string"
EXTERNAL = "title string, text string, label int"
CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of files is read in parallel; article bodies may hold newlines."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def read_numbered(spark: SparkSession, path: str, schema: str, first: int = 0) -> DataFrame:
    """Rows with ``doc_id`` from ``first`` on, in the order of file paths and of rows inside a file.

    A file with multi-line cells is never divided, so its rows are read one
    after the other in one task. They are written with their places; the
    numbers then do not depend on how files were put into tasks.
    """
    raw = read_csv(spark, path, schema)
    names = raw.columns
    if "doc_id" in names:
        return raw
    placed = materialize(raw.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_place")), "numbered")
    # One row per file.
    files = placed.groupBy("_file").agg(F.count("*").alias("_n"), F.min("_place").alias("_start"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_file").select(*names, (F.col("_place") - F.col("_start") + F.col("_before") + first).alias("doc_id"))


def load_labelled_pair(spark: SparkSession, zeros: str, ones: str, schema: str = ARTICLE) -> DataFrame:
    """One source per class, class 0 first."""
    class_0 = read_numbered(spark, zeros, schema)
    taken = 0 if "doc_id" in spark.createDataFrame([], schema).columns else class_0.count()
    return union_classes(class_0, read_numbered(spark, ones, schema, taken))


def load_external(spark: SparkSession, path: str, schema: str = EXTERNAL, limit: int | None = None) -> DataFrame:
    """Second corpus: nulls become empty texts; optionally its first rows only."""
    df = fill_missing(normalize_label(read_numbered(spark, path, schema)))
    return df if limit is None else limit_rows(df, limit)


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n rows in file order (a bare limit would take any rows)."""
    return df.orderBy("doc_id").limit(n)


def normalize_label(df: DataFrame) -> DataFrame:
    """Call the label column ``label``, whether it is label or target; none is fine."""
    if "label" not in df.columns and "target" in df.columns:
        return df.withColumnRenamed("target", "label")
    return df


def load_csv_optional_label(spark: SparkSession, path: str) -> DataFrame:
    """Batch table whose header decides which optional columns exist."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    types = {"label": "int", "target": "int", "doc_id": "bigint"}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in header)
    return fill_missing(normalize_label(read_numbered(spark, path, schema)))
