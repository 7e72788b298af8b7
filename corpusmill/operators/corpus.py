"""Corpus preparation: labelled union, cleaning, exact de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions.text import build_content, clean_text


def file_order(label: Column, position: Column) -> Column:
    """Sorts like (class, row position): class 0 is read first, rows without a class last."""
    return F.struct(label.isNull().alias("unlabelled"), label.alias("label"), position.alias("position"))


def require_columns(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    needed = ["title", "text"] + (["subject"] if config.include_subject else [])
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def union_classes(zeros: DataFrame, ones: DataFrame) -> DataFrame:
    """Label two per-class frames and stack them, class 0 first."""
    return (zeros.withColumn("label", F.lit(0))
            .unionByName(ones.withColumn("label", F.lit(1)), allowMissingColumns=True))


def fill_missing(df: DataFrame) -> DataFrame:
    return df.fillna("", subset=[c for c in ("title", "text", "subject") if c in df.columns])


def drop_leaky_columns(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    return df.drop("date") if config.drop_date else df


def content_digest(content: Column, subject: Column | None = None) -> Column:
    """32-byte key for grouping equal texts without moving the texts."""
    if subject is None:
        return F.unhex(F.sha2(content, 256))
    both = F.concat(F.sha2(content, 256), F.sha2(subject, 256))
    return F.unhex(F.sha2(both, 256))


def drop_exact_duplicates(df: DataFrame, with_subject: bool = False) -> DataFrame:
    """Keep the first row in file order of every content (and subject).

    Needs ``doc_id``, ``content`` and ``label``; any id and a null label keep
    their values. The group key is a digest and the survivor is picked by
    ``min_by``, so equal rows collapse on the map side and a text that fills a
    third of the corpus stays cheap. Columns nobody reads afterwards are pruned
    out of the aggregate by Catalyst.
    """
    order = file_order(F.col("label"), F.col("doc_id"))
    digest = content_digest(F.col("content"), F.col("subject") if with_subject else None)
    keyed = df.withColumns({"_order": order, "_digest": digest})
    return keyed.groupBy("_digest").agg(*[F.min_by(c, "_order").alias(c) for c in df.columns]).drop("_digest")


def drop_empty(df: DataFrame) -> DataFrame:
    return df.where(F.length("content") > 0)


def clean_frame(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Row-preserving cleaning used at inference.

    Only with ``fill_missing_with_empty`` off are rows without title or text dropped.
    """
    if not config.fill_missing_with_empty:
        missing = [c for c in ("title", "text") if c in df.columns]
        df = df.where(" AND ".join(f"{c} IS NOT NULL" for c in missing))
    content = clean_text(build_content(F.col("title"), F.col("text")), config)
    keep = [c for c in ("doc_id", "label") if c in df.columns]
    subject = []
    if config.include_subject and "subject" in df.columns:
        subject = [F.coalesce("subject", F.lit("")).alias("subject")]
    return df.select(*keep, content.alias("content"), *subject)


def prepare_corpus(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Check, clean, de-duplicate, then drop texts that became empty."""
    out = clean_frame(require_columns(df, config), config)
    if not config.drop_exact_duplicates:
        return drop_empty(out)
    # The length travels on its own: who only counts labels or ranks identifiers
    # then reads no text through the exchange.
    sized = out.withColumn("_length", F.length("content"))
    firsts = drop_exact_duplicates(sized, with_subject=config.include_subject)
    return firsts.where(F.col("_length") > 0).drop("_length")


def split_overlap(split: DataFrame) -> DataFrame:
    """Count of contents present on both sides; 0 proves there is no leak."""
    sides = (split.groupBy(content_digest(F.col("content")).alias("digest"))
             .agg(F.max((F.col("split") == "train").cast("int")).alias("in_train"),
                  F.max((F.col("split") == "test").cast("int")).alias("in_test")))
    return sides.agg(
        F.coalesce(F.sum(F.col("in_train") * F.col("in_test")), F.lit(0)).cast("long").alias("n_shared"))
