"""Exact order statistics over a hash order, without sorting the rows.

A seeded split needs "the first k rows in random order" per class. Ranking all
rows of a class would put it into one task. Here rows are counted per hash
bucket, the bucket holding rank k is found on that small table, and only the
rows of that one bucket are ranked. The result is a threshold hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_DIGITS = 3
BUCKETS = 16 ** BUCKET_DIGITS


def hash_order(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(doc_id.cast("string"), F.lit(f":{seed}")))


def class_sizes(df: DataFrame, stratum: str) -> DataFrame:
    return df.groupBy(F.col(stratum).alias("_stratum")).agg(F.count("*").alias("_n"))


def cut_hashes(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """Hash of every wanted rank.

    ``keyed``: (_stratum, _hash). ``targets``: (_stratum, _slot, _rank), a few
    rows per stratum. Returns (_stratum, _cuts) with the cuts in ascending
    order; ranks of 0 give no cut.
    """
    keyed = keyed.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    running = Window.partitionBy("_stratum").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # At most BUCKETS rows per stratum reach this window.
    filled = (keyed.groupBy("_stratum", "_bucket").agg(F.count("*").alias("_n"))
              .withColumn("_upto", F.sum("_n").over(running)))
    located = (filled.join(targets, "_stratum")
               .where((F.col("_rank") <= F.col("_upto"))
                      & (F.col("_rank") > F.col("_upto") - F.col("_n")))
               .select("_stratum", "_bucket", "_slot",
                       (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_offset")))
    ranked = (keyed.join(located, ["_stratum", "_bucket"])
              .withColumn("_pos", F.row_number().over(
                  Window.partitionBy("_stratum", "_bucket", "_slot").orderBy("_hash")))
              .where(F.col("_pos") == F.col("_offset")))
    return ranked.groupBy("_stratum").agg(F.sort_array(F.collect_list("_hash")).alias("_cuts"))


def cuts_below(df: DataFrame, cuts: DataFrame, stratum: str, hashed: Column) -> DataFrame:
    """Add ``_below``: how many cuts of the row's stratum lie below its hash.

    ``_cuts`` (null where the stratum has none) stays for the caller to drop.
    """
    joined = df.join(cuts.withColumnRenamed("_stratum", stratum), stratum, "left").withColumn("_hash", hashed)
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_hash")))
    return joined.withColumn("_below", F.when(F.col("_cuts").isNull(), 0).otherwise(below))
