"""I-Match fingerprints over randomised lexicons."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import utf8
from corpusmill.llm.suffix import _mix, _sums

RAREST, COMMONEST = 0.0005, 0.1   # band of document frequency, as shares of all documents
SUBSETS = 24                      # randomised lexicons per density
MOST_LEVEL = 24                   # thinnest lexicon keeps one term in 2**24
LOWEST = 1 - (1 << 63)            # where a null id stands in the order of ids
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SEEDS = _mix(np.arange(1, SUBSETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def term_hashes(text: str) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased words of a text."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    inside = _WORD_BYTE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return np.unique(_sums(data.astype(np.uint64) + np.uint64(1), edges[::2], edges[1::2], 0))


def lexicon(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency lies in the band.

    Tasks count distinct terms per document, Spark sums the counts over the
    whole corpus. A term of the band is in at least ``RAREST`` of all
    documents, so the band holds at most (mean distinct terms of a document) /
    ``RAREST`` terms, however large the corpus is; that is what the driver gets.
    """
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, 0

        def flush() -> pa.RecordBatch:
            term, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n, pa.int64())], ["term", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(term_hashes(text or ""))
                size += len(held[-1])
            if size > 8_000_000:
                yield flush()
                held, size = [], 0
        yield flush()

    total = docs.count()
    df = docs.select("text").mapInArrow(counts, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    band = df.where((F.col("n") >= max(2, RAREST * total)) & (F.col("n") <= max(2, COMMONEST * total))).select("term")
    return np.sort(band.toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def fingerprint(text: str, terms_in_band: np.ndarray) -> str:
    """``full:level:parts`` of a text.

    ``full`` is the digest of the sorted distinct terms inside the lexicon.
    ``parts`` are short hashes of the terms inside ``SUBSETS`` random subsets
    of the lexicon at three densities, one term in 2**level and thinner,
    so that a subset holds a few of this text's terms and outlives an edit
    elsewhere; dots stand where it holds none. A text without a term in the
    lexicon is named by its own digest.
    """
    terms = term_hashes(text)
    at = np.searchsorted(terms_in_band, terms)
    at[at == len(terms_in_band)] = 0
    terms = terms[terms_in_band[at] == terms] if len(terms_in_band) else terms[:0]
    if not len(terms):
        return f"{hashlib.sha256(text.encode()).hexdigest()[:16]}::"
    level = min(MOST_LEVEL, int(round(np.log2(len(terms)))))
    draws = _mix(terms[:, None] ^ _SEEDS[None, :])
    values = _mix(terms ^ np.uint64(0x2545F4914F6CDD1D))[:, None]
    parts = []
    for depth in range(level, level + 3):
        member = (draws & np.uint64((1 << depth) - 1)) == 0
        sums = _mix(np.where(member, values, np.uint64(0)).sum(axis=0, dtype=np.uint64)) >> np.uint64(48)
        parts += [f"{s:04x}" if m else "...." for s, m in zip(sums.tolist(), member.any(axis=0).tolist())]
    return f"{hashlib.sha256(terms.tobytes()).hexdigest()[:16]}:{level}:{''.join(parts)}"


def likeness(a: str, b: str) -> float:
    """Share of equal parts among those of the shared densities that either text fills; 1 for equal full digests."""
    full_a, level_a, parts_a = a.split(":")
    full_b, level_b, parts_b = b.split(":")
    if full_a == full_b:
        return 1.0
    if not level_a or not level_b or abs(int(level_a) - int(level_b)) > 2:
        return 0.0
    shift = int(level_b) - int(level_a)
    width = 4 * SUBSETS
    left = parts_a[max(0, shift) * width:(3 + min(0, shift)) * width]
    right = parts_b[max(0, -shift) * width:(3 - max(0, shift)) * width]
    pairs = [(left[i:i + 4], right[i:i + 4]) for i in range(0, len(left), 4)]
    filled = [p for p in pairs if p != ("....", "....")]
    return sum(x == y for x, y in filled) / len(filled) if filled else 0.0


def _chained(docs: DataFrame) -> DataFrame:
    """(part, guest, place, hash, doc_id, compressed text) rows, dealt and sorted so that each row's next document follows it.

    Ids are cut into ranges at approximate quantiles. The highest row of each
    range also goes, as a guest, behind the lowest row of the range above; the
    highest of all goes behind the lowest of all.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("place"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
                       "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("place", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def deal(guests: dict[tuple[int, int], int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = batch.column(0).to_numpy(zero_copy_only=False)
                part = np.searchsorted(bounds, place)
                both = [(i, guests[k]) for i, k in enumerate(zip(place.tolist(), batch.column(1).to_pylist())) if k in guests]
                take = pa.array([*range(batch.num_rows), *(i for i, _ in both)], pa.int64())
                columns = batch.columns
                if len(columns) == 4:
                    # Texts cross the exchange compressed.
                    squeeze = zstandard.ZstdCompressor(level=1).compress
                    columns = [*columns[:3], pa.array([squeeze(t) for t in utf8(columns[3])], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*part.tolist(), *(p for _, p in both)], pa.int64()), pa.array([False] * batch.num_rows + [True] * len(both)),
                     *(c.take(take) for c in columns)], ["part", "guest", *batch.schema.names])
        return run

    schema = f"part bigint, guest boolean, place bigint, hash bigint, doc_id {kind}"
    firsts = rows.drop("text").mapInArrow(deal({}), schema).groupBy("part").agg(F.min(F.struct(-F.col("place"), "hash")).alias("first"), F.max("place").alias("high"))
    heads = sorted((r["part"], r["high"], r["first"]["hash"]) for r in firsts.collect())      # one per range
    above = {(high, code): heads[(i + 1) % len(heads)][0] for i, (_, high, code) in enumerate(heads)}
    dealt = rows.mapInArrow(deal(above), schema + ", text binary")
    return dealt.repartition("part").sortWithinPartitions("part", "guest", F.col("place").desc(), "hash")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The edited text is the document with its last third of code points
    replaced by the start of the next document in descending id order (of the
    last: the first). Equal ids are ordered by a hash of the text, null ids
    come last, null texts are empty; a single document is its own next. The
    texts are shuffled once; the lexicon is read from the whole corpus.
    """
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast(lexicon(docs).tobytes())
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.frombuffer(words.value, np.uint64)
        unsqueeze = zstandard.ZstdDecompressor().decompress
        held = None

        def finish(text: str, own: str, after: str, print_after: str) -> tuple:
            third = len(text) // 3
            edited = text[:len(text) - third] + after[:third]
            changed = fingerprint(edited, band)
            return (len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, likeness(own, changed), likeness(own, print_after))

        for batch in batches:
            ids, rows = [], []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 4, 5)]
            for part, guest, doc_id, squeezed in zip(*columns):
                if held is not None and held[0] != part:
                    raise ValueError("a range lost its guest")
                if guest and held is None:
                    continue          # a repeated guest
                text = unsqueeze(squeezed).decode()
                own = fingerprint(text, band)
                if held is not None:
                    ids.append(held[1])
                    rows.append(finish(held[2], held[3], text, own))
                held = None if guest else (part, doc_id, text, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(4).type), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())))], names)

    return _chained(docs).mapInArrow(run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
