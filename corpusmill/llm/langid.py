"""Language identification with error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import map_rows, materialize
from corpusmill.llm.toxicity import hash_rest

MOST_TRAINING_ROWS = 20_000     # documents the classifiers are fitted on, chosen by hash
MOST_LANGUAGES = 1_000          # bound of the count table that reaches the driver
SLOT_BITS = 15                  # hash slots of bigrams, and as many of trigrams
EXHAUSTIVE = 7                  # up to this many languages every split is a bit
AMBIGUOUS = 0.9                 # a score below this is flagged
BLOCK = 1 << 16                 # bytes of a text that are looked up at once
UNKNOWN = "und"
_SLOTS = 1 << SLOT_BITS


def has_letter(text: str) -> bool:
    """Whether a text has a letter; numerals such as one half or a Roman nine are none."""
    return any(map(str.isalpha, text))


def gram_slots(text: str) -> np.ndarray:
    """Slots of the UTF-8 bigrams and trigrams of the lower-cased text, padded by one blank on each side."""
    b = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    three = two[:-1] << np.uint32(8) | b[2:]
    shift = np.uint32(32 - SLOT_BITS)
    return np.concatenate([(two * np.uint32(0x9E3779B1)) >> shift, ((three * np.uint32(0x85EBCA6B)) >> shift) + np.uint32(_SLOTS)])


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Code of +1 and -1 by language and bit.

    Few languages get all splits into two non-empty sides; many get random
    balanced bits, the best of several draws by the smallest distance between
    codewords.
    """
    if n == 1:
        return np.ones((1, 1))
    if n <= EXHAUSTIVE:
        bits = np.arange(1, 1 << (n - 1))
        return np.where(bits[None, :] >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    width = int(np.ceil(10 * np.log2(n)))
    best = None
    for _ in range(20):
        code = np.stack([rng.permutation(np.where(np.arange(n) % 2, 1.0, -1.0)) for _ in range(width)], axis=1)
        gap = (width - code @ code.T) / 2 + np.eye(n) * width
        if best is None or gap.min() > best[0]:
            best = (gap.min(), code)
    return best[1]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray          # language x bit
    weights: np.ndarray       # slot x bit: log odds of a slot for the bit's positive side

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous) by loss-weighted decoding of the bits' margins."""
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0, True
        slots = gram_slots(text)
        total = np.zeros(self.code.shape[1])
        for at in range(0, len(slots), BLOCK):
            total += self.weights[slots[at:at + BLOCK]].sum(axis=0, dtype=np.float64)
        # Neighbouring n-grams repeat each other's evidence, so it grows with the root of their number.
        margins = total / np.sqrt(len(slots))
        loss = np.logaddexp(0, -self.code * margins[None, :]).sum(axis=1)
        chances = np.exp(loss.min() - loss)
        score = float(1 / chances.sum())
        return self.languages[int(loss.argmin())], score, score < AMBIGUOUS


def training_rows(docs: DataFrame, rows: int = MOST_TRAINING_ROWS) -> DataFrame:
    """(text, lang) of documents outside the held-out quarter, ``rows`` at most in expectation, by hash."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (hash_rest("doc_id", 4) != 2))
    share = min(1.0, rows / max(1, usable.count()))
    return usable.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) < int(share * 1_000_000)).select("text", "lang")


def fit(rows: DataFrame) -> LanguageModel:
    """Learn from (text, lang) rows.

    Tasks count slots by language and Spark sums them; the driver gets one
    number per language and slot. A bit's classifier weighs a slot by the log
    odds of its share in the languages on either side, each counted alike.
    """
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(text):
                    held.setdefault(lang, np.zeros(2 * _SLOTS, np.int64))
                    held[lang] += np.bincount(gram_slots(text), minlength=2 * _SLOTS)
        for lang, n in held.items():
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int64()), pa.array(n[slot], pa.int64())], ["lang", "slot", "n"])

    table = materialize(rows.mapInArrow(counts, "lang string, slot bigint, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")), "gram-counts")
    names = [r[0] for r in table.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MOST_LANGUAGES).select("lang").collect()]
    if not names:
        return LanguageModel((), np.ones((0, 0)), np.zeros((0, 0)))
    names.sort()
    index = {name: i for i, name in enumerate(names)}
    count = np.full((len(names), 2 * _SLOTS), 0.1)
    got = table.where(F.col("lang").isin(names)).toPandas()
    count[got["lang"].map(index).to_numpy(), got["slot"].to_numpy()] += got["n"].to_numpy()
    share = count / count.sum(axis=1, keepdims=True)
    code = codewords(len(names))
    sides = [np.log(np.stack([share[code[:, b] == s].mean(axis=0) if (code[:, b] == s).any() else share.mean(axis=0) for b in range(code.shape[1])], axis=1)) for s in (1, -1)]
    return LanguageModel(tuple(names), code, (sides[0] - sides[1]).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) per row from the whole text.

    A text that is null or has no letter is ``und`` with score 0; so is every
    text if nothing could be learned. Only doc_id and text are read; repeated
    rows stay; no rows give no rows.
    """
    def of_batch(batch: pa.RecordBatch) -> dict:
        found = [model.predict(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "ambiguous": [f[2] for f in found]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), of_batch, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def language_of(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous): fit outside the held-out quarter, predict every document."""
    found = identify(docs, fit(training_rows(docs)))
    return found.select("doc_id", (hash_rest("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
