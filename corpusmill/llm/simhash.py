"""SimHash near-duplicates found through deletion-variant signatures."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.llm.common import broadcast_measured, map_rows, materialize, never_broadcast, utf8
from corpusmill.llm.components import connected_components

MAX_BITS = 2       # fingerprints link at this many differing bits or fewer
SEGMENTS = 2       # of 32 bits: with two differing bits, one segment has at most one of them
CROWDED = 16       # a signature shared by more fingerprints than this is not paired off
BLOCK = 1 << 16    # shingles whose bits are counted at once


def simhash64(text: bytes, words: int = 3) -> int:
    """Signed 64-bit SimHash of the ``words``-word shingles of a UTF-8 text.

    A-Z is lowered, words are runs of anything but ASCII white space, repeats
    count. A shorter text is one shingle; a text without words gives 0.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[len(tokens) - n:].tolist()
    spans = (joined[a:b] for a, b in zip(starts, stops))
    return bits_of(np.fromiter(map(xxhash.xxh64_intdigest, spans, repeat(42)), np.uint64, n))


def bits_of(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash of shingle hashes, repeats counted; 0 without any."""
    ones, n = np.zeros(64, np.int64), len(hashes)
    for at in range(0, n, BLOCK):
        part = np.ascontiguousarray(hashes[at:at + BLOCK]).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((ones * 2 > n).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row; a null text is empty. Other columns are not read."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def of_batch(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column(0), "fp": [simhash64(t, words) for t in utf8(batch.column(1))]}

    return map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), of_batch,
                    f"id {id_type}, fp bigint")


def _variants():
    """Signatures of a fingerprint: each segment with each of its bits cut out."""
    width = 64 // SEGMENTS
    out = []
    for s in range(SEGMENTS):
        segment = F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit((1 << width) - 1))
        for i in range(width):
            kept = segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << i)))
            out.append(kept.bitwiseOR(F.lit((s * width + i) << width)))
    return F.explode(F.array(*out))


def links(distinct_fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints within ``MAX_BITS`` bits.

    Signatures are joined on equality and the pairs verified. A signature
    shared by more than ``CROWDED`` fingerprints would make a quadratic number
    of pairs; its members are linked exactly another way: two words differ in
    at most two bits if and only if some word differs from each in at most
    one, so each member names its 65 such words, and every word links its
    members to the smallest of them.
    """
    keys = distinct_fps.select("fp", _variants().alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    cand = materialize(keys.join(never_broadcast(shared), "key"), "simhash-candidates")
    few = cand.where(F.col("members") <= CROWDED).select("key", "fp")
    pairs = (few.select("key", F.col("fp").alias("a")).join(never_broadcast(few.select("key", F.col("fp").alias("b"))), "key")
             .where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
             .select("a", "b").distinct())
    near = F.explode(F.array(F.col("fp"), *[
        F.col("fp").bitwiseXOR(F.lit((1 << i) if i < 63 else -(1 << 63))) for i in range(64)]))
    hubs = cand.where(F.col("members") > CROWDED).select("fp").distinct().select(F.col("fp").alias("a"), near.alias("hub"))
    least = hubs.groupBy("hub").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return pairs.unionByName(hubs.join(never_broadcast(least), "hub").where("a <> b").select("a", "b").distinct())


def components_of(distinct_fps: DataFrame) -> DataFrame:
    """(fp, root) of every distinct fingerprint: equal roots where links lead from one to the other."""
    roots = connected_components(links(distinct_fps), "a", "b")
    return distinct_fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicate_groups(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component) per row; ``component`` is the smallest id reachable over links.

    Copies share a fingerprint and are one node of the graph. Null ids are
    ignored by the minimum (a component of null ids only has none); an empty
    table gives no rows; repeated rows stay repeated.
    """
    fps = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = materialize(fps.groupBy("fp").agg(F.min("id").alias("first")), "fp-classes")
    roots = connected_components(links(classes.select("fp")), "a", "b")
    rooted = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    member = materialize(rooted.join(smallest, "root").select("fp", "component"), "fp-components")
    return fps.join(member, "fp").select("id", "fp", "component")


def keep_one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id's (null last), then the smallest text hash.

    Rows that repeat both are reduced to one. Columns stay as they are; texts
    move only where a whole row repeats.
    """
    code = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = materialize(fingerprints(docs.select("doc_id", "text", code.alias("code")).select(
        F.struct("doc_id", "code").alias("id"), "text"), id_col="id").select("id.doc_id", "id.code", "fp"), "coded-fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "code"))
    classes = materialize(rows.groupBy("fp").agg(best.alias("first")), "fp-classes")
    roots = connected_components(links(classes.select("fp")), "a", "b")
    kept = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("first"))
            .select(F.col("first.doc_id").alias("__id"), F.col("first.code").alias("__code")))
    return keep_rows(docs, rows, materialize(kept, "kept-rows"), code)


def keep_rows(docs: DataFrame, rows: DataFrame, kept: DataFrame, code: Column) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names by (__id, __code), each once; ``rows`` has doc_id and code of all rows."""
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & (code == F.col("__code"))
    once = docs.join(kept, match, "semi")
    again = materialize(rows.groupBy("doc_id", "code").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("__id"), F.col("code").alias("__code")), "repeated-rows")
    if again.isEmpty():
        return once
    repeated = broadcast_measured(again, 48)
    first = once.join(repeated, match, "semi").withColumn("__code", code).dropDuplicates(["doc_id", "__code"]).select(*docs.columns)
    return once.join(repeated, match, "anti").unionByName(first)
