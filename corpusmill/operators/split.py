"""Seeded splits and folds, reproducible on any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusmill.operators.hashrank import class_sizes, cut_hashes, cuts_below, hash_order


def _keyed(df: DataFrame, stratum: str, seed: int) -> DataFrame:
    return df.select(F.col(stratum).alias("_stratum"),
                     hash_order(F.col("doc_id"), seed).alias("_hash"))


def _mark(df: DataFrame, cuts: DataFrame, stratum: str, seed: int) -> DataFrame:
    marked = cuts_below(df, cuts, stratum, hash_order(F.col("doc_id"), seed))
    is_test = F.col("_cuts").isNotNull() & (F.col("_below") == 0)
    return (marked.withColumn("split", F.when(is_test, "test").otherwise("train"))
            .drop("_cuts", "_hash", "_below"))


def test_quotas(sizes: DataFrame, test_size: float) -> DataFrame:
    """Test rows per class: ceil of the total, shared by largest remainder."""
    whole = Window.partitionBy()
    # Decimals: the product of two row counts outgrows a long.
    shared = F.col("_n").cast("decimal(19,0)") * F.col("_n_test").cast("decimal(19,0)")
    by_remainder = whole.orderBy(F.desc("_part"), "_stratum")
    return (
        # One row per class, so these windows hold a handful of rows.
        sizes.withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_n_test", F.ceil(F.col("_total") * test_size))
        .withColumn("_shared", shared)
        .withColumn("_floor", F.expr("_shared div _total"))
        .withColumn("_part", F.expr("_shared % _total"))
        .withColumn("_left", F.col("_n_test") - F.sum("_floor").over(whole))
        .withColumn("_rank", F.col("_floor") + (F.row_number().over(by_remainder) <= F.col("_left")).cast("long"))
        .select("_stratum", F.lit(0).alias("_slot"), "_rank")
    )


def stratified_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                     stratum: str = "label") -> DataFrame:
    """Add ``split``: 'test' for the first hash ranks of every class."""
    targets = test_quotas(class_sizes(df, stratum), test_size)
    return _mark(df, cut_hashes(_keyed(df, stratum, seed), targets), stratum, seed)


def random_split(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Unstratified split; the test side holds floor(n * test_size) rows."""
    one = df.withColumn("_all", F.lit(0))
    targets = class_sizes(one, "_all").select(
        "_stratum", F.lit(0).alias("_slot"), F.floor(F.col("_n") * test_size).alias("_rank"))
    return _mark(one, cut_hashes(_keyed(one, "_all", seed), targets), "_all", seed).drop("_all")


def _even_cuts(df: DataFrame, parts: int, seed: int, stratum: str) -> DataFrame:
    """Cuts that divide every class into ``parts`` equal runs of hash order."""
    targets = class_sizes(df, stratum).select(
        "_stratum", F.explode(F.sequence(F.lit(1), F.lit(parts - 1))).alias("_slot"), "_n",
    ).select("_stratum", "_slot", F.ceil(F.col("_n") * F.col("_slot") / parts).alias("_rank"))
    return cut_hashes(_keyed(df, stratum, seed), targets)


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, stratum: str = "label") -> DataFrame:
    """Add ``fold`` 0..k-1; the folds of a class differ by one row at most."""
    cuts = _even_cuts(df, k, seed, stratum)
    marked = cuts_below(df, cuts, stratum, hash_order(F.col("doc_id"), seed))
    return marked.withColumn("fold", F.col("_below").cast("int")).drop("_cuts", "_hash", "_below")


def training_folds(split: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1 to the rows of the training side; null on the test side.

    Folds over both sides would follow the order that the split was made by,
    so the first of five would hold the test side and no training row.
    """
    train = split.where(F.col("split") == "train")
    rest = split.where(~F.col("split").eqNullSafe(F.lit("train"))).withColumn("fold", F.lit(None).cast("int"))
    return stratified_folds(train, k, seed).unionByName(rest)


def nested_tenths(df: DataFrame, parts: int = 10, seed: int = 7, stratum: str = "label") -> DataFrame:
    """Add ``part`` 1..parts: the sample of size i/parts is ``part <= i``."""
    cuts = _even_cuts(df, parts, seed, stratum)
    marked = cuts_below(df, cuts, stratum, hash_order(F.col("doc_id"), seed))
    return (marked.withColumn("part", (F.col("_below") + 1).cast("int"))
            .drop("_cuts", "_hash", "_below"))
