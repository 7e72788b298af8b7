"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge; ``root`` is the smallest node of its component.

    Large-star links a node's larger neighbours to the smallest node around
    it, small-star does the same for smaller neighbours; the rounds grow with
    the logarithm of the longest path. Each round is written to the shared
    folder, so lineage stays short and a lost executor repeats one round.
    Nothing is collected but a count and two checksums. Nodes are longs that
    are not null; self loops and repeated edges are ignored; no edges give no
    rows.
    """
    current = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    before = _signature(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        current = materialize(small, "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
