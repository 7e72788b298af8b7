"""How the given tables stand in for the corpora."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.config import FeatureConfig
from corpusmill.operators.corpus import clean_frame, drop_empty, drop_exact_duplicates, prepare_corpus
from corpusmill.operators.split import stratified_split
from corpusmill.session import materialize, spread

EXTERNAL_SOURCES = ["src15", "src16", "src17", "src18", "src19"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text", "source", "lang")


def _as_articles(documents: DataFrame, *keep: str) -> DataFrame:
    """They are dealt by ``doc_id``, the key of the joins that follow, so tasks are even however the files were cut."""
    title = F.substring_index("text", "\n", 1)
    body = F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)")
    return spread(documents).select(
        "doc_id", title.alias("title"), body.alias("text"), F.col("source").alias("subject"),
        "lang", F.col("doc_id").cast("string").alias("date"), *keep)


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """All documents; the first line is the title, the rest the text."""
    return _as_articles(_documents(spark, sf))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled corpus: label = quality. Texts without a label are dropped before texts are dealt."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    return _as_articles(_documents(spark, sf).join(labels, "doc_id"), "label")


def in_domain(df: DataFrame) -> DataFrame:
    return df.where(~F.col("subject").isin(EXTERNAL_SOURCES))


def external(df: DataFrame) -> DataFrame:
    return df.where(F.col("subject").isin(EXTERNAL_SOURCES))


def corpus(spark: SparkSession, sf: str, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Prepared labelled corpus (doc_id, content, label)."""
    return prepare_corpus(labelled(spark, sf), config)


def all_contents(spark: SparkSession, sf: str) -> DataFrame:
    """Every document cleaned, none dropped."""
    return clean_frame(articles(spark, sf))


def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    """Every document cleaned and de-duplicated; unlabelled, so order is doc_id."""
    return drop_empty(drop_exact_duplicates(all_contents(spark, sf).withColumn("label", F.lit(0))))


def split_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_split(corpus(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """A scored frame with many ties, built from whole numbers only.

    The score is the share of distinct words in thousandths; the prediction is
    score >= 0.5. It exercises the metrics exactly in both engines.
    """
    words = F.split(F.col("content"), " ")
    mills = F.expr("(1000 * size(array_distinct(_w))) div size(_w)")
    return (corpus(spark, sf).select("doc_id", "label", words.alias("_w"))
            .select("doc_id", "label", (mills / F.lit(1000.0)).alias("score"))
            .withColumn("pred", (F.col("score") >= 0.5).cast("int")))


@dataclass
class Sides:
    """Split corpus in a written table: several steps of a query read it."""

    all: DataFrame
    train: DataFrame
    test: DataFrame


def sides(spark: SparkSession, sf: str) -> Sides:
    split = materialize(stratified_split(materialize(corpus(spark, sf), "prepared")), "split")
    return Sides(split, split.where(F.col("split") == "train").drop("split"),
                 split.where(F.col("split") == "test").drop("split"))
