"""Alignment of two tokenizers over the same bytes by galloping intersection of their token ends."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from corpusmill.llm.common import materialize, utf8

TOKENIZERS = "/opt/tokenizers"
FIRST, SECOND = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
STRIDE = 8                # every so many ends are searched first and anchor those between them
TEXT_BYTES = 1 << 19      # of texts that a worker aligns at once; a longer text goes alone
HELD_PAIRS = 4_000_000    # pair counts that a task holds before it sums or passes them on
ROWS_PER_BATCH = 1000     # rows of an Arrow batch: long token lists pass between the JVM and Python in small pieces
FREQUENT = 1 << 18        # most linked pairs whose counts are sent to the workers; rarer ones are joined

# Fixed value: the pattern that the byte-level pre-tokenizer of the vocabulary file splits by.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass
class Encoder:
    """Ids of texts without special tokens, and the bytes of each id."""
    encode: object
    token_bytes: list[bytes]

    def __post_init__(self):
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def byte_level(file: bytes) -> Encoder:
    """A byte-level BPE vocabulary (JSON), encoding a blank and the text.

    Where ids follow the order of the merges they are ranks, and the faster
    rank encoder gives the same ids; another vocabulary runs as it is.
    """
    model, letters = json.loads(file), byte_level_alphabet()
    vocab, added = model["model"]["vocab"], {t["content"] for t in model["added_tokens"]}
    plain = {t: i for t, i in vocab.items() if t not in added}
    names = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in model["added_tokens"])]))
    for token, i in plain.items():
        names[i] = bytes(letters[c] for c in token)
    for t in model["added_tokens"]:
        names[t["id"]] = t["content"].encode()
    merged = [plain["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["model"]["merges"]]
    by_rank = all(a < b for a, b in zip(merged, merged[1:])) and len(merged) + 256 == len(plain) and (
        model["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        and model["normalizer"] is None and not model["model"].get("ignore_merges"))
    if by_rank:
        ranks = tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks={names[i]: i for i in plain.values()}, special_tokens={})
        return Encoder(lambda texts: [ranks.encode_ordinary(" " + t) for t in texts], names)
    whole = Tokenizer.from_str(file.decode())
    whole.encode_special_tokens = True
    return Encoder(lambda texts: [e.ids for e in whole.encode_batch([" " + t for t in texts], add_special_tokens=False)], names)


def pieces(file: bytes) -> Encoder:
    """A piece model with byte fallback, which adds the leading blank itself."""
    model = sentencepiece.SentencePieceProcessor(model_proto=file)
    names = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
             for i in range(model.get_piece_size())]
    return Encoder(lambda texts: model.encode(texts, num_threads=1), names)


_LOADED: dict[bytes, Encoder] = {}


def encoder(file: bytes) -> Encoder:
    """The encoder of a vocabulary file's content, built once per process."""
    key = hashlib.sha256(file).digest()
    if key not in _LOADED:
        _LOADED[key] = byte_level(file) if file.lstrip()[:1] == b"{" else pieces(file)
    return _LOADED[key]


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of the sorted ``short`` the first place in the sorted ``long`` that is not below it.

    Every ``STRIDE``-th value is placed first and the values after it start
    there: steps double until they pass the value, then the last step is
    halved. All values of a level move at once.
    """
    if len(short) <= STRIDE:
        low = np.zeros(len(short), np.int64)
    else:
        low = np.repeat(gallop(short[::STRIDE], long), STRIDE)[:len(short)]
    n = len(long)
    high = low.copy()
    todo = np.flatnonzero((low < n) & (long[np.minimum(low, n - 1)] < short)) if n else np.zeros(0, np.int64)
    bracketed, step = todo, 1
    while len(todo):
        probe = low[todo] + step
        below = (probe < n) & (long[np.minimum(probe, n - 1)] < short[todo])
        high[todo[~below]] = np.minimum(probe[~below], n)
        todo = todo[below]
        low[todo] = probe[below]
        step *= 2
    low[bracketed] += 1
    open_ = bracketed[low[bracketed] < high[bracketed]]
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = long[middle] < short[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


@dataclass
class Alignment:
    """Common cuts and links of two token lists that cover the same bytes."""
    cuts_a: np.ndarray      # per group, tokens of A up to its end
    cuts_b: np.ndarray
    link_a: np.ndarray      # per link, the place of its A token
    link_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Align increasing end offsets; the shorter list drives the search.

    A token of the driving list overlaps the other list from the rank of its
    start to the rank of its end, so rank differences are its links.
    """
    swapped = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
    at = gallop(short, long)
    same = long[np.minimum(at, len(long) - 1)] == short if len(long) else np.zeros(len(short), bool)
    first = np.concatenate(([0], (at + same)[:-1])) if len(at) else at
    count = at - first + 1
    of_short = np.repeat(np.arange(len(short)), count)
    of_long = np.arange(len(of_short)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    cuts = np.flatnonzero(same) + 1, at[same] + 1
    return Alignment(*(cuts[::-1] if swapped else cuts), *((of_long, of_short) if swapped else (of_short, of_long)))


def _batches(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows with about ``TEXT_BYTES`` of text."""
    start, held, size = 0, [], 0
    for i, text in enumerate(utf8(column)):
        held.append(text)
        size += len(text)
        if size >= TEXT_BYTES:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def encode_both(texts: list[bytes], a: Encoder, b: Encoder) -> tuple[list[list[int]], list[list[int]]]:
    """Token ids of both encoders per text; none where a text is empty, not UTF-8 or not restored by either."""
    found = []
    for t in texts:
        try:
            found.append(t.decode())
        except UnicodeDecodeError:
            found.append("")
    ids_a, ids_b = a.encode(found), b.encode(found)
    for i, t in enumerate(found):
        whole = b" " + t.encode()
        if not t or b"".join(map(a.token_bytes.__getitem__, ids_a[i])) != whole or b"".join(map(b.token_bytes.__getitem__, ids_b[i])) != whole:
            ids_a[i], ids_b[i] = [], []
    return ids_a, ids_b


class _Counts:
    """Numbers of documents per linked pair, summed in bounded memory."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, pairs: np.ndarray) -> bool:
        """Count sorted or unsorted pair keys; true when the held counts should be passed on."""
        keys, counts = np.unique(pairs, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size <= HELD_PAIRS:
            return False
        keys, counts = self.take()
        self.keys, self.counts, self.size = [keys], [counts], len(keys)
        return self.size > HELD_PAIRS // 2

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([*self.keys, np.zeros(0, np.int64)]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([*self.counts, np.zeros(0, np.int64)]), len(keys)).astype(np.int64)
        self.keys, self.counts, self.size = [], [], 0
        return keys, counts


def _distinct(rows: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Pairs of each row once, given rows in order."""
    order = np.lexsort((pairs, rows)) if len(pairs) else np.zeros(0, np.int64)
    rows, pairs = rows[order], pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (pairs[1:] != pairs[:-1])
    return pairs[new]


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``ROWS_PER_BATCH`` rows for the jobs that run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(ROWS_PER_BATCH))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _files(first: str, second: str) -> tuple[bytes, bytes]:
    return Path(first).read_bytes(), Path(second).read_bytes()


def _lists(ids: list[list[int]]) -> pa.Array:
    return pa.array(ids, pa.list_(pa.int32()))


def encode_documents(docs: DataFrame, first: str = FIRST, second: str = SECOND, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One written table of two kinds of rows: documents (id, row, a, b) and counts (pair, n).

    ``a`` and ``b`` are the token ids; ``n`` is the number of documents of a
    task that hold the pair ``A id * size of B + B id`` linked. Both come from
    one pass, so no text is encoded twice. ``row`` names the row, as ids may
    be null or repeated.
    """
    files = _files(first, second)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = map(encoder, files)
        counts = _Counts()

        def passed_on() -> pa.RecordBatch:
            pairs, n = counts.take()
            return pa.RecordBatch.from_arrays([pa.nulls(len(pairs), kind), *[pa.nulls(len(pairs), pa.list_(pa.int32()))] * 2, pa.array(pairs), pa.array(n)], names)

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for start, texts in _batches(batch.column(1)):
                ids_a, ids_b = encode_both(texts, a, b)
                lists = _lists(ids_a), _lists(ids_b)
                flat_a, flat_b = (x.values.to_numpy().astype(np.int64) for x in lists)
                found = align(np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b]))
                row_of = np.repeat(np.arange(len(texts)), list(map(len, ids_a)))
                pairs = flat_a[found.link_a] * len(b.token_bytes) + flat_b[found.link_b]
                more = counts.add(_distinct(row_of[found.link_a], pairs))
                nothing = pa.nulls(len(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *lists, nothing, nothing], names)
                if more:
                    yield passed_on()
        if kind is not None:
            yield passed_on()

    names = ["id", "a", "b", "pair", "n"]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, a array<int>, b array<int>, pair bigint, n bigint")
    with _small_batches(docs.sparkSession):
        return materialize(out.withColumn("row", F.monotonically_increasing_id()), "token-lists")


def documents_of(encoded: DataFrame) -> DataFrame:
    """(row, id, a, b) of ``encode_documents``."""
    return encoded.where("pair is null").select("row", "id", "a", "b")


def pair_counts(encoded: DataFrame, second_size: int) -> DataFrame:
    """(pair, a, n, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = materialize(encoded.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).withColumn(
        "a", F.expr(f"cast(pair div {second_size} as int)")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))     # as many rows as A has ids
    return materialize(counts.join(most, "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def frequent_pairs(counts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sorted keys, counts and best flags of at most ``most`` pairs, those in the highest classes of counts; the lowest count of these classes."""
    step = F.floor(F.log2("n") * 8)
    classes = counts.groupBy(step.alias("class")).agg(F.count("*").alias("pairs"), F.min("n").alias("low")).orderBy(F.desc("class")).collect()
    held, low = 0, 1 << 62
    for c in classes:
        held += c.pairs
        if held > most:
            break
        low = c.low
    table = counts.where(F.col("n") >= low).select("pair", "n", "best").toPandas().sort_values("pair")
    return table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64), table["best"].to_numpy(bool), low


def alignments(documents: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """The groups and overlap ranges of token lists, per row of ``documents_of``.

    ``cuts_a`` and ``cuts_b`` hold, per group, how many tokens of each list
    end by its end; tokens of A at place i overlap the tokens of B from
    ``first_b[i]`` up to and without ``last_b[i]``. A row without tokens has
    empty arrays.
    """
    files = _files(first, second)
    id_type = documents.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = map(encoder, files)
        for batch in batches:
            out = [[], [], [], []]
            for ids_a, ids_b in zip(batch.column(2), batch.column(3)):
                x, y = (np.asarray(v.values, np.int64) for v in (ids_a, ids_b))
                found = align(np.cumsum(a.lengths[x]), np.cumsum(b.lengths[y]))
                order = np.argsort(found.link_a, kind="stable")
                starts = np.searchsorted(found.link_a[order], np.arange(len(x)))
                stops = np.searchsorted(found.link_a[order], np.arange(len(x)), side="right")
                linked = found.link_b[order]
                for held, values in zip(out, (found.cuts_a, found.cuts_b, linked[starts], linked[stops - 1] + 1)):
                    held.append(values)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(v, pa.list_(pa.int32())) for v in out)], names)

    names = ["row", "id", "cuts_a", "cuts_b", "first_b", "last_b"]
    return documents.mapInArrow(run, f"row bigint, id {id_type}, " + ", ".join(f"{n} array<int>" for n in names[2:]))


def _group_texts(flat_a: np.ndarray, flat_b: np.ndarray, found: Alignment, names_a: np.ndarray, names_b: np.ndarray) -> np.ndarray:
    """Decimal ids in the order of the groups, each with its mark: ``,``, or at a group's end ``|`` for A and ``;`` for B."""
    groups_a = np.diff(found.cuts_a, prepend=0)
    groups_b = np.diff(found.cuts_b, prepend=0)
    before_a = np.repeat(found.cuts_b - groups_b, groups_a)      # B tokens of earlier groups
    before_b = np.repeat(found.cuts_a, groups_b)                 # A tokens up to this group
    out = np.empty(len(flat_a) + len(flat_b), object)
    last_a, last_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
    last_a[found.cuts_a - 1] = 1
    last_b[found.cuts_b - 1] = 1
    out[np.arange(len(flat_a)) + before_a] = names_a[last_a, flat_a]
    out[np.arange(len(flat_b)) + before_b] = names_b[last_b, flat_b]
    return out


def summaries(encoded: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Per document: tokens, groups, links, and how common its linked pairs are in the whole corpus.

    Counts of the most frequent pairs, a bounded number, travel to the
    workers; links of rarer pairs are joined with the table of counts. Rows:
    id, n_a, n_b, n_groups, n_links, n_best (links whose pair no other pair of
    the A id exceeds), count_sum, groups (hash of the groups' ids).
    """
    files = _files(first, second)
    size_b = len(encoder(files[1]).token_bytes)
    counts = pair_counts(encoded, size_b)
    keys, numbers, flags, _ = frequent_pairs(counts)
    spark: SparkSession = encoded.sparkSession
    shared = spark.sparkContext.broadcast((keys, numbers, flags))
    documents = documents_of(encoded)
    id_type = documents.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = map(encoder, files)
        known, number, best = shared.value
        names_a, names_b = (np.array([[f"{i}{m}" for i in range(len(e.token_bytes))] for m in marks], object) for e, marks in ((a, ",|"), (b, ",;")))
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                lists = batch.column(2), batch.column(3)
                flat_a, flat_b = (x.flatten().to_numpy().astype(np.int64) for x in lists)
                sizes_a, sizes_b = (np.diff(np.asarray(x.offsets)) for x in lists)
                found = align(np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b]))
                n = batch.num_rows
                row_of = np.repeat(np.arange(n), sizes_a)
                row = row_of[found.link_a]
                pairs = flat_a[found.link_a] * size_b + flat_b[found.link_b]
                place = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
                hit = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
                sums = np.zeros((2, n), np.int64)
                if len(known):
                    np.add.at(sums[0], row[hit], best[place[hit]])
                    np.add.at(sums[1], row[hit], number[place[hit]])
                texts = _group_texts(flat_a, flat_b, found, names_a, names_b)
                ends = np.cumsum(sizes_a + sizes_b)
                digests = [hashlib.sha256("".join(texts[e - s:e])[:-1].encode()).hexdigest() if s else ""
                           for s, e in zip((sizes_a + sizes_b).tolist(), ends.tolist())]
                rare = np.flatnonzero(~hit)
                rare_sizes = np.bincount(row[rare], minlength=n)
                order = rare[np.argsort(row[rare], kind="stable")]
                rest = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(rare_sizes))), pa.int32()), pa.array(pairs[order]))
                per_row = [sizes_a, sizes_b, np.bincount(row_of[found.cuts_a - 1], minlength=n), np.bincount(row, minlength=n), *sums]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in per_row), pa.array(digests, pa.string()), rest], names)

    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "rare"]
    with _small_batches(spark):
        found = materialize(documents.mapInArrow(run, f"row bigint, id {id_type}, " + ", ".join(f"{n} bigint" for n in names[2:8]) + ", groups string, rare array<bigint>"), "alignments")
    linked = found.where(F.size("rare") > 0).select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("links"))
    more = linked.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("links") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    add = lambda c, m: (F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c)
    return found.drop("rare").join(more, "row", "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", add("n_best", "more_best"), add("count_sum", "more_sum"), "groups")


def align_documents(docs: DataFrame, first: str = FIRST, second: str = SECOND, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``summaries`` of a table of texts, one row per row.

    A text that is null, empty, not UTF-8, or not restored byte for byte by
    either tokenizer has no tokens: zeros and an empty hash. Repeated rows
    count as documents of their own, null ids stay null, an empty table gives
    no rows, other columns are not read. Longest held at once: one text.
    """
    return summaries(encode_documents(docs, first, second, id_col, text_col), first, second)
