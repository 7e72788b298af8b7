"""Joins whose sides Spark would size by their files, not by the rows that an explode makes of them."""

from pyspark.sql import functions as F

from corpusmill.llm import common, simhash


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deletion_variants_are_never_broadcast(spark, tmp_path, monkeypatch):
    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/fps")
    plans, written = [], simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df, name: (plans.append(_plan(df)), written(df, name))[1])
    edges = simhash.links(spark.read.parquet(f"{tmp_path}/fps"))
    for plan in (*plans, _plan(edges)):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_side_over_its_limit_is_not_broadcast_nor_the_other(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/ids")
    ids = spark.read.parquet(f"{tmp_path}/ids")
    exploded = ids.select("id", F.explode(F.array(*[F.lit(i) for i in range(64)])).alias("n"))
    assert "BroadcastHashJoin" in _plan(exploded.join(common.broadcast_measured(ids, 8, 8 * 100), "id"))
    over = exploded.join(common.broadcast_measured(ids, 8, 8 * 99), "id")
    assert "SortMergeJoin" in _plan(over) and "Broadcast" not in _plan(over) and over.count() == 6400
