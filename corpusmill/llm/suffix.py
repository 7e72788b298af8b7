"""Substring de-duplication with prefix-partitioned suffix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from corpusmill.llm.common import broadcast_measured, map_rows, materialize, utf8

SPAN = 50                  # words of a window
PREFIX = 16                # words of the short prefix by which suffixes are first dealt
OFFSETS = SPAN - PREFIX + 1
LENGTHS = (24, 32, 40)     # words that a crowded prefix is lengthened to, until its subtree fits; the last step is the window
CROWDED = 8192             # suffixes of a prefix that one subtree may hold (some 100 MB); beyond, the prefix is lengthened
BUNDLE = 4096              # suffixes whose subtrees are built at once in a task
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)   # odd multipliers of the rolling sums
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown as texts need them."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(b) for b in _BASES]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:stop] for each pair: equal content, equal hash."""
    up, down = _POWERS[base].to(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return _mix((total[stops] - total[starts]) * down[starts])


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the runs of anything but ASCII white space."""
    blank = _SPACE[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    return edges[::2], edges[1::2]


def _word_hashes(text: bytes, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    return _sums(np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1), starts, stops, base)


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the suffixes of a text start: (word, hash of its prefix, first window, last window).

    Among the prefixes inside a window the one with the smallest hash anchors
    it (the first of equals), so equal windows have equal anchors at equal
    places. Neighbouring windows mostly share one.
    """
    starts, stops = word_bounds(text)
    n = len(starts)
    if n < SPAN:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty, empty
    at = np.arange(n - PREFIX + 1)
    grams = _sums(_word_hashes(text, starts, stops, 0), at, at + PREFIX, 1)
    least = np.lib.stride_tricks.sliding_window_view(grams, OFFSETS).argmin(axis=1) + np.arange(n - SPAN + 1)
    first = np.flatnonzero(np.diff(least, prepend=-1))
    last = np.append(first[1:], len(least)) - 1
    return least[first], grams[least[first]], first, last


def _emit_anchors(batch: pa.RecordBatch) -> dict:
    """One row per text and prefix, however often the text repeats it; a place is a window run's start and length."""
    ids, keys, prefixes, places, sizes, counts = batch.column(0), batch.column(1), [], [], [], []
    for text in utf8(batch.column(2)):
        _, prefix, first, last = anchors(text)
        order = np.argsort(prefix, kind="stable")
        distinct, size = np.unique(prefix, return_counts=True)
        prefixes.append(distinct.view(np.int64))
        places.append((first << 6 | (last - first))[order])
        sizes.append(size)
        counts.append(len(distinct))
    of = pa.array(np.repeat(np.arange(len(counts)), counts))
    ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
    return {"doc_id": ids.take(of), "key": keys.take(of), "prefix": pa.array(np.concatenate(prefixes)),
            "places": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(places)))}


def _emit_suffixes(batch: pa.RecordBatch) -> dict:
    """Per anchor with a repeated prefix its words; per distinct window under a crowded prefix its longer prefixes."""
    out = {n: [] for n in ("doc_id", "key", "prefix", "first", "last", "words", "steps", "long1", "long2", "starts")}

    def add(*row) -> None:
        for column, value in zip(out.values(), row):
            column.append(value)

    ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    for doc_id, key, text, shared in zip(ids, keys, utf8(batch.column(2)), batch.column(3).to_pylist()):
        starts, stops = word_bounds(text)
        crowded = []
        for s in shared:
            place = np.array(s["places"], np.int64)
            runs = zip((place >> 6).tolist(), ((place >> 6) + (place & 63)).tolist())
            for first, last in runs:
                if s["crowded"]:
                    crowded.append(np.arange(first, last + 1))
                else:
                    add(doc_id, key, s["prefix"], first, last, text[starts[first]:stops[last + SPAN - 1]], None, None, None, None)
        if crowded:
            each = np.unique(np.concatenate(crowded))
            hashes = [_word_hashes(text, starts, stops, b) for b in (0, 1)]
            long1, long2 = (_sums(hashes[b], each, each + SPAN, 1 - b).view(np.int64) for b in (0, 1))
            steps = np.stack([_sums(hashes[0], each, each + n, 1).view(np.int64) for n in LENGTHS], axis=1)
            order = np.lexsort((each, long2, long1))
            cuts = np.flatnonzero((np.diff(long1[order]) != 0) | (np.diff(long2[order]) != 0)) + 1
            for same in np.split(order, cuts):
                add(doc_id, key, None, None, None, None, steps[same[0]].tolist(), int(long1[same[0]]), int(long2[same[0]]), each[same].tolist())
    return out


def _emit_lengthened(batch: pa.RecordBatch) -> dict:
    """The words of each window whose lengthened prefix has a group that fits."""
    out = {n: [] for n in ("doc_id", "key", "prefix", "first", "last", "words", "starts")}
    for doc_id, key, text, wanted in zip(*(batch.column(i).to_pylist() for i in (0, 1)), utf8(batch.column(2)), batch.column(3).to_pylist()):
        starts, stops = word_bounds(text)
        for w in wanted:
            first = w["starts"][0]
            for column, value in zip(out.values(), (doc_id, key, w["prefix"], first, first, text[starts[first]:stops[first + SPAN - 1]], w["starts"])):
                column.append(value)
    return out


def suffix_array(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places of the first words, ranks): ranks[k] orders all places by their next 2**k words.

    Every entry ends in a mark of its own, so no two suffixes are equal beyond
    the end of an entry and the last ranks order whole suffixes.
    """
    tokens = [w.split() for w in words]
    sizes = np.array([len(t) for t in tokens])
    codes = pd.factorize(np.array([w for t in tokens for w in t], dtype=object))[0].astype(np.int64)
    ends = np.cumsum(sizes + 1) - 1
    rank = np.empty(len(codes) + len(words), np.int64)
    word = np.ones(len(rank), bool)
    word[ends] = False
    rank[word], rank[ends] = codes, codes.max(initial=-1) + 1 + np.arange(len(words))
    ranks = [rank]
    while (depth := 1 << (len(ranks) - 1)) < sizes.max(initial=0):
        right = np.concatenate((ranks[-1][depth:] + 1, np.zeros(min(depth, len(rank)), np.int64)))[:len(rank)]
        ranks.append(np.unique(ranks[-1] * (len(rank) + 1) + right, return_inverse=True)[1])
    return ends - sizes, ranks


def common_words(ranks: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at each pair of places."""
    at, to = left.copy(), right.copy()
    for k in range(len(ranks) - 1, -1, -1):
        step = (ranks[k][at] == ranks[k][to]).astype(np.int64) << k
        at += step
        to += step
    return at - left


def deep_repeats(ids: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, words: list[bytes], earlier: bool) -> list[tuple[int, int, int]]:
    """(row, from, to): the maximal word ranges of a row that lie below a deep node.

    The rows are whole prefix groups, their leaves the suffixes from each
    window's first word. A node at depth d is a run of leaves, in suffix order,
    with d words in common. Per leaf the deepest node of ``SPAN`` words and more
    counts that holds a smaller id (``earlier``) or any other id; a range inside
    the one of the leaf before is not maximal and left out.
    """
    places, ranks = suffix_array(words)
    counts = lasts - firsts + 1
    row = np.repeat(np.arange(len(ids)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = places[row] + within
    leaf = np.argsort(ranks[-1][start], kind="stable")
    shared = np.concatenate(([0], common_words(ranks, start[leaf[:-1]], start[leaf[1:]])))
    deepest = np.zeros(len(row), np.int64)
    for depth in range(SPAN, int(shared.max()) + 1):
        opens = shared < depth
        opens[:1] = True
        node, id_of, begin = np.cumsum(opens) - 1, ids[row[leaf]], np.flatnonzero(opens)
        least, most = np.minimum.reduceat(id_of, begin), np.maximum.reduceat(id_of, begin)
        deepest[leaf[id_of > least[node] if earlier else (least < most)[node]]] = depth
        several = (least < most)[node]
        leaf, shared = leaf[several], shared[several]
        if not len(leaf):
            break
    reach = np.where(deepest > 0, within + deepest, 0)
    before = np.concatenate(([0], np.where(row[1:] == row[:-1], reach[:-1], 0)))
    top = np.flatnonzero(reach > before)
    at = firsts[row[top]]
    return list(zip(row[top].tolist(), (at + within[top]).tolist(), (at + reach[top]).tolist()))


def _repeats_of(earlier: bool):
    """Batches come sorted by prefix; groups are gathered into bundles, never split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in _with_end(batches):
            part = None if batch is None else batch.to_pandas()
            frame = part if waiting is None else waiting if part is None else pd.concat([waiting, part], ignore_index=True)
            if frame is None or not len(frame):
                continue
            edges = np.flatnonzero(np.diff(frame["prefix"].to_numpy())) + 1
            stop = len(frame) if batch is None else int(edges[-1]) if len(edges) else 0
            begin = 0
            for edge in [*edges[edges <= stop].tolist(), *([stop] if batch is None else [])]:
                if edge - begin >= BUNDLE or edge == stop:
                    some = frame.iloc[begin:edge]
                    begin = edge
                    if len(some):
                        found = deep_repeats(*(some[c].to_numpy(np.int64) for c in ("doc_id", "first", "last")), list(some["words"]), earlier)
                        rows = [f[0] for f in found]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(some["doc_id"].to_numpy()[rows], pa.int64()),
                            "key": pa.array(some["key"].to_numpy()[rows], pa.int64()),
                            "from": pa.array([f[1] for f in found], pa.int64()), "to": pa.array([f[2] for f in found], pa.int64()),
                            "starts": pa.array(some["starts"].to_numpy()[rows].tolist(), pa.list_(pa.int64()))})
            waiting = frame.iloc[stop:].reset_index(drop=True)
    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _finish(batch: pa.RecordBatch) -> dict:
    out = {"doc_id": batch.column(0), "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
    for text, copy, ranges in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        words = text.split()
        n = len(words)
        gone = 0
        if copy and n >= SPAN:
            words, gone = [], n
        elif ranges:
            depth = np.zeros(n + 1, np.int64)
            for r in ranges:
                depth[r["from"]] += 1
                depth[r["to"]] -= 1
            keep = np.flatnonzero(np.cumsum(depth)[:n] == 0)
            words, gone = [words[i] for i in keep], n - len(keep)
        kept = b" ".join(words)
        out["n_words"].append(n)
        out["n_removed"].append(gone)
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["kept_text"].append(kept.decode())
    return out


def _with_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key, original, latest): smallest and greatest id of equal texts, null where a text occurs once."""
    rows = docs.select(F.col("doc_id").cast(LongType()).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.md5("text")).withColumn("key", F.xxhash64("text"))
    copies = materialize(rows.select("digest", "doc_id").groupBy("digest").agg(
        F.min("doc_id").alias("original"), F.max("doc_id").alias("latest"), F.count("*").alias("n")).where("n > 1").drop("n"), "whole-copies")
    return rows.join(broadcast_measured(copies, 64), "digest", "left").drop("digest")


def _lengthened_groups(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the windows under crowded prefixes: (windows with the prefix whose group fits, windows that are a group of their own).

    Prefixes are lengthened step by step. Counts are per distinct window, which
    is one row however many texts hold it, and windows of one id end here.
    """
    distinct = materialize(windows.groupBy("long1", "long2", "steps").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).where("lo < hi"), "crowded-windows")
    prefix = F.lit(None).cast("bigint")
    for at in reversed(range(len(LENGTHS))):
        step = F.col("steps")[at]
        fits = distinct.groupBy(step.alias(f"p{at}")).agg(F.sum("n").alias(f"n{at}")).where(f"n{at} <= {CROWDED}").select(f"p{at}")
        distinct = distinct.join(fits, step == F.col(f"p{at}"), "left")
        prefix = F.coalesce(f"p{at}", prefix)
    settled = materialize(distinct.select("long1", "long2", "steps", "lo", "hi", prefix.alias("prefix")), "lengthened-prefixes")
    found = windows.join(settled, ["long1", "long2", "steps"])
    return (found.where("prefix IS NOT NULL").select("doc_id", "key", "prefix", "starts"),
            found.where("prefix IS NULL").select("doc_id", "key", "starts", "lo", "hi"))


def _repeated_ranges(judged: DataFrame, earlier: bool) -> DataFrame:
    """(doc_id, key, ranges) of the texts in (doc_id, key, text) with words below deep nodes."""
    dealt = materialize(map_rows(judged, _emit_anchors, "doc_id bigint, key bigint, prefix bigint, places array<bigint>"), "anchors")
    shared = dealt.groupBy("prefix").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.sum(F.size("places")).alias("n"))
    shared = shared.where("lo < hi").select("prefix", (F.col("n") > CROWDED).alias("crowded"))
    wanted = materialize(
        dealt.join(shared, "prefix").groupBy("doc_id", "key").agg(F.collect_list(F.struct("prefix", "places", "crowded")).alias("shared")),
        "wanted-anchors")

    def texts_with(wanted: DataFrame) -> DataFrame:
        few = broadcast_measured(wanted.select("doc_id", "key"), 32)
        return judged.join(few, ["doc_id", "key"], "semi").join(wanted, ["doc_id", "key"])

    suffixes = materialize(map_rows(
        texts_with(wanted).select("doc_id", "key", "text", "shared"), _emit_suffixes,
        "doc_id bigint, key bigint, prefix bigint, first bigint, last bigint, words binary, steps array<bigint>, long1 bigint, long2 bigint, starts array<bigint>"),
        "suffixes")
    leaves = suffixes.where("words IS NOT NULL").select("doc_id", "key", "prefix", "first", "last", "words", "starts")
    windows = suffixes.where("words IS NULL").select("doc_id", "key", "steps", "long1", "long2", "starts")
    nodes = None
    if not windows.isEmpty():
        fitting, nodes = _lengthened_groups(windows)
        again = materialize(fitting.groupBy("doc_id", "key").agg(F.collect_list(F.struct("prefix", "starts")).alias("wanted")), "wanted-windows")
        leaves = leaves.unionByName(map_rows(
            texts_with(again).select("doc_id", "key", "text", "wanted"), _emit_lengthened,
            "doc_id bigint, key bigint, prefix bigint, first bigint, last bigint, words binary, starts array<bigint>"))

    def windows_at(starts):
        return F.transform(starts, lambda s: F.struct(s.alias("from"), (s + SPAN).alias("to")))

    ranges = (leaves.repartition("prefix").sortWithinPartitions("prefix")
              .mapInArrow(_repeats_of(earlier), "doc_id bigint, key bigint, `from` bigint, `to` bigint, starts array<bigint>")
              .select("doc_id", "key", F.coalesce(windows_at("starts"), F.array(F.struct("from", "to"))).alias("ranges")))
    if nodes is not None:
        ranges = ranges.unionByName(nodes.where("doc_id > lo" if earlier else "lo < hi").select("doc_id", "key", windows_at("starts").alias("ranges")))
    return materialize(ranges.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "repeated-ranges")


def _beside(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    width = ranges.agg(F.max(F.size("ranges"))).first()[0] or 1
    return rows.join(broadcast_measured(ranges, 32 + 16 * width), ["doc_id", "key"], "left")


def drop_repeated_spans(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) per row; words under a repeated window are gone.

    A window of ``SPAN`` words goes if a row with a smaller id has it too.

    * Whole copies are found by digest; they need no tree.
    * Only anchored suffixes (about one word in eighteen) are dealt by the
      hash of their first ``PREFIX`` words, and only prefixes that occur under
      two ids go on. A prefix with more than ``CROWDED`` suffixes is lengthened
      by the steps of ``LENGTHS`` until its group fits. Where even the whole
      window is crowded, its group is a single node, and an aggregate finds the
      smallest id, so no group is ever larger than a task can hold.
    * A task sorts the suffixes of its groups (suffix array and common-prefix
      lengths, which are the subtree); a leaf's deepest node of ``SPAN`` words
      and more with a smaller id is its maximal repeat, and those cover what goes.

    Hashes only deal and prune; suffixes of a subtree are compared word by
    word, windows that are a node of their own by 128 bits. Null texts have no
    words. Rows with a null id neither lose words nor take them from others;
    rows with the same id leave each other alone. Extra columns are ignored.
    """
    rows = _with_copies(docs).withColumn("copy", F.coalesce(F.col("doc_id") > F.col("original"), F.lit(False))).drop("original", "latest")
    ranges = _repeated_ranges(rows.where("NOT copy AND doc_id IS NOT NULL").select("doc_id", "key", "text"), earlier=True)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return map_rows(_beside(rows, ranges).select("doc_id", "text", "copy", "ranges"), _finish, schema + ", kept_text string" if keep_text else schema)


def _emit_spans(batch: pa.RecordBatch) -> dict:
    out = {n: [] for n in ("doc_id", "first_word", "n_words", "span")}
    for doc_id, text, whole, ranges in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        words = text.split()
        joined: list[list[int]] = []
        for begin, end in [(0, len(words))] if whole else sorted({(r["from"], r["to"]) for r in ranges or []}):
            # Neighbours that share all but one word of a window have no unrepeated window between them.
            if joined and begin <= joined[-1][1] - SPAN + 1:
                joined[-1][1] = max(joined[-1][1], end)
            elif end - begin >= SPAN:
                joined.append([begin, end])
        for begin, end in joined:
            for column, value in zip(out.values(), (doc_id, begin, end - begin, b" ".join(words[begin:end]).decode())):
                column.append(value)
    return out


def maximal_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, first_word, n_words, span): the longest stretches of a row whose every window of ``SPAN`` words is in a row of another id too.

    Found as in ``drop_repeated_spans``, with any other id in place of a smaller
    one; a repeat longer than the words of a leaf is joined from the nodes along
    its text. Words count from 0. Rows with a null id, null and short texts have
    none; rows with the same id are not each other's repeats, and a row that is
    there twice returns its stretches twice. Extra columns are ignored.
    """
    rows = _with_copies(docs).where("doc_id IS NOT NULL").withColumn("whole", F.coalesce(F.col("original") < F.col("latest"), F.lit(False)))
    # Of equal texts the two outermost ids stand for all: any other id differs from one of them.
    judged = rows.where("NOT whole OR doc_id = original OR doc_id = latest").select("doc_id", "key", "text")
    return map_rows(_beside(rows, _repeated_ranges(judged, earlier=False)).select("doc_id", "text", "whole", "ranges"), _emit_spans,
                    "doc_id bigint, first_word bigint, n_words bigint, span string")


REPEATS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 win AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (
        SELECT rid, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
 least AS (SELECT s, min(doc_id) AS lo FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
 gone AS (SELECT rid, list(DISTINCT p) AS ps FROM (SELECT rid, unnest(range(i, i + 50)) AS p FROM win JOIN least USING (s) WHERE doc_id > lo) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
    sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_select(w, list_sort(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(ps, x)))) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid)"""
