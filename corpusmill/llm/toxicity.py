"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded texts."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.llm.common import materialize, slices

MOST_TRAINING_ROWS = 20_000     # labelled rows that the lexicon and the scale are fitted on, chosen by hash
MOST_ENTRIES = 5_000            # lexicon candidates, most frequent first
STEMS = range(3, 10)            # lengths of word beginnings that may become entries
LEAST_WEIGHT = 3.0              # log odds ratio of an entry
FEWEST = 3                      # labelled rows an entry or exception phrase needs
MOST_EXCEPTIONS = 1_000
LENGTH_POWERS = (0.0, 0.25, 0.5, 1.0)
HIGHEST_BIAS = -0.05            # a text without a match is never predicted to be toxic

# Letters that look like Latin ones (Cyrillic, Greek, others). Styled, circled and full-width letters and marks follow by rule.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕԁԛԝһкмтвнгѵ" "αβεικνορτυχγω" "ıɑɡℓоօոս",
    "aeopcyxijsdqwhkmtbhrv" "abeiknoptuxyw" "iagloonu") | {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
DIGITS = str.maketrans("013457@$!|", "oieastasii")
_DIGIT = re.compile(r"[013457@$!|]")
_INSIDE = re.compile(r"[013457@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[013457]+")
_WORD = re.compile(r"[^\W\d_]+")


class _Plain(dict):
    """Character -> plain characters, worked out once each: compatibility form without marks, then the look-alikes."""

    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFKD", chr(code).lower()).lower()
        bare = "".join(c for c in parts if not unicodedata.category(c).startswith("M"))
        # A digit, sign or blank of another shape keeps its place: only letters are folded.
        letters = all(map(str.isalpha, bare)) if bare else unicodedata.category(chr(code)).startswith("M")
        self[code] = (bare if letters else chr(code).lower()).translate(HOMOGLYPHS)
        return self[code]


_PLAIN = _Plain()


def fold(text: str) -> str:
    """Lower case, look-alike letters as Latin ones, digits and signs next to letters as the letters they stand for.

    Styled, circled and full-width letters and letters with marks become plain
    ones, whichever way their marks are written. "1" may stand for i or l, so
    l is written as i throughout.
    """
    text = text.lower()
    if not text.isascii():
        text = text.translate(_PLAIN)
    if _DIGIT.search(text):
        text = _INSIDE.sub(lambda m: m.group().translate(DIGITS), text)
    return text.replace("l", "i")


def entries_of(text: str) -> set[str]:
    """Possible lexicon entries of a folded text: whole words ("word$") and their beginnings."""
    found = set()
    for word in set(_WORD.findall(text)):
        found.add(word + "$")
        found.update(word[:n] for n in STEMS if n <= len(word))
    return found


@dataclass(frozen=True)
class ToxicityModel:
    """Folded entries with weights, phrases in which an entry does not count, and the scale of the score."""
    lexicon: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    power: float = 0.0
    slope: float = 1.0
    bias: float = -1.0


class Matcher:
    """Aho-Corasick over a model's entries."""

    def __init__(self, model: ToxicityModel):
        self.model, self.machine = model, ahocorasick.Automaton()
        for entry in model.lexicon:
            self.machine.add_word(entry.removesuffix("$"), [])
        for entry, weight in model.lexicon.items():
            self.machine.get(entry.removesuffix("$")).append((entry, len(entry.removesuffix("$")), weight))
        self.machine.make_automaton()

    def hits(self, text: str) -> Iterator[tuple[str, float, str, str]]:
        """(entry, weight, phrase with the word before, phrase with the word after) per match in a folded text."""
        if not self.model.lexicon:
            return
        for end, found in self.machine.iter(text):
            for entry, length, weight in found:
                start = end - length + 1
                if start and text[start - 1].isalpha():
                    continue
                stop = end + 1
                while stop < len(text) and text[stop].isalpha():
                    stop += 1
                if entry.endswith("$") and stop != end + 1:
                    continue
                before = _WORD.findall(text[max(0, start - 40):start])[-1:]
                after = _WORD.findall(text[stop:stop + 40])[:1]
                yield entry, weight, " ".join([*before, entry]) if before else "", " ".join([entry, *after]) if after else ""

    def total(self, text: str) -> tuple[float, int]:
        """(weights of the matches outside exception phrases, words) of a text as it is."""
        folded = fold(text)
        allowed = self.model.exceptions
        weight = sum(w for _, w, a, b in self.hits(folded) if a not in allowed and b not in allowed)
        return weight, len(text.split())

    def score(self, text: str) -> float:
        weight, words = self.total(text)
        return _logistic(self.model.slope * math.log1p(weight / (1 + words) ** self.model.power) + self.model.bias)


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -30 else math.exp(max(x, -700))


def hash_rest(column: str, parts: int) -> Column:
    """crc32 of a column as text, modulo ``parts``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = MOST_TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out fifth, ``rows`` of them at most in expectation, by hash."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (hash_rest("doc_id", 5) != 0)).select("doc_id", "toxic")
    share = min(1.0, rows / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, "doc_id").select("text", "toxic")


def _count(rows: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                counts.update(fn(text))
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["entry", "n"])
                counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["entry", "n"])

    return rows.select("text").mapInArrow(run, schema).groupBy("entry").agg(F.sum("n").alias("n"))


def choose_entries(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries with a high log odds ratio, each as specific as its count allows, none below another of like weight."""
    def weight(e: str) -> float:
        return math.log((toxic[e] + 0.5) / (n_toxic + 1)) - math.log((clean.get(e, 0) + 0.5) / (n_clean + 1))

    good = {e: weight(e) for e in toxic if toxic[e] >= FEWEST}
    good = {e: w for e, w in good.items() if w >= LEAST_WEIGHT}
    chosen: dict[str, float] = {}
    for e in sorted(good, key=lambda e: (len(e), e)):
        stems = [e.removesuffix("$")[:n] for n in range(1, len(e) + 1)]
        if any(s in chosen and chosen[s] >= good[e] - 0.7 for s in stems if s != e):
            continue
        chosen[e] = good[e]
    out = {}
    by_stem = sorted(good)
    for e, w in chosen.items():
        same = [g for g in by_stem if g != e and not e.endswith("$") and g.startswith(e) and toxic[g] >= 0.98 * toxic[e] and good[g] >= w - 0.1]
        best = max(same, key=len, default=e)
        out[best] = good[best]
    return out


def fit(rows: DataFrame) -> ToxicityModel:
    """Learn entries, exception phrases and the scale from (text, toxic) rows.

    Counts are made in the tasks and summed by Spark; the driver gets at most
    ``MOST_ENTRIES`` entries, ``MOST_EXCEPTIONS`` phrases and one number pair
    for each of the bounded training rows.
    """
    rows = materialize(rows, "toxicity-training")
    sizes = {bool(r["t"]): r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    rate = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    prior = ToxicityModel({}, bias=min(HIGHEST_BIAS, math.log(rate / (1 - rate))))
    if not n_toxic or not n_clean:
        return prior

    def entries(text: str) -> set[str]:
        return entries_of(fold(text))

    toxic = {r["entry"]: r["n"] for r in _count(rows.where("toxic > 0"), entries, "entry string, n bigint").where(
        F.col("n") >= max(FEWEST, n_toxic // 500)).orderBy(F.col("n").desc(), "entry").limit(4 * MOST_ENTRIES).collect()}
    names = frozenset(toxic)
    clean = {r["entry"]: r["n"] for r in _count(rows.where("toxic <= 0"), lambda t: entries(t) & names, "entry string, n bigint").collect()}
    chosen = choose_entries(toxic, clean, n_toxic, n_clean)
    lexicon = dict(sorted(chosen.items(), key=lambda x: -toxic[x[0]])[:MOST_ENTRIES])
    if not lexicon:
        return prior
    model = ToxicityModel(lexicon)

    def phrases(model: ToxicityModel):
        cache = []

        def of(text: str) -> set[str]:
            cache[:] = cache or [Matcher(model)]
            return {p for _, _, a, b in cache[0].hits(fold(text)) for p in (a, b) if p}
        return of

    in_clean = {r["entry"]: r["n"] for r in _count(rows.where("toxic <= 0"), phrases(model), "entry string, n bigint").where(
        F.col("n") >= FEWEST).orderBy(F.col("n").desc(), "entry").limit(MOST_EXCEPTIONS).collect()}
    if in_clean:
        in_toxic = {r["entry"]: r["n"] for r in _count(rows.where("toxic > 0"), phrases(model), "entry string, n bigint").where(
            F.col("entry").isin(list(in_clean))).collect()}
        model = ToxicityModel(lexicon, frozenset(p for p, n in in_clean.items() if n / n_clean >= 5 * in_toxic.get(p, 0) / n_toxic))
    return _scaled(model, rows)


def _scaled(model: ToxicityModel, rows: DataFrame) -> ToxicityModel:
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            pairs = [matcher.total(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.int64()), batch.column(1)],
                                             ["weight", "words", "toxic"])

    found = rows.select("text", F.col("toxic").cast("int")).mapInArrow(totals, "weight double, words bigint, toxic int").toPandas()
    y = (found["toxic"].to_numpy() > 0).astype(float)
    best = None
    for power in LENGTH_POWERS:
        x = np.log1p(found["weight"].to_numpy() / (1.0 + found["words"].to_numpy()) ** power)
        slope, bias, loss = _logistic_fit(x, y)
        if best is None or loss < best[0] - 1e-6:
            best = (loss, power, slope, bias)
    _, power, slope, bias = best
    return ToxicityModel(model.lexicon, model.exceptions, power, slope, min(HIGHEST_BIAS, bias))


def _logistic_fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[float, float, float]:
    """Slope, bias and mean loss of a penalised logistic fit in one variable, by Newton steps."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag([penalty, 1e-6]), a.T @ (p - y) + penalty * w * [1, 0])
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -30, 30))), 1e-12, 1 - 1e-12)
    return float(w[0]), float(w[1]), float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on) for the whole text; a null text is empty.

    The model is bounded by ``MOST_ENTRIES`` and ``MOST_EXCEPTIONS`` and goes
    with the task. Columns named score or predicted are replaced; repeated
    rows stay; no rows give no rows.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(kept).schema), "score double, predicted int"])
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            scores = [matcher.score(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                                             [*kept, "score", "predicted"])

    return docs.select(*kept).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without the rows that the model predicts to be toxic; columns stay as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            yield batch.filter(pa.array([matcher.score(t or "") < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): fit on labels outside the held-out fifth, score every document."""
    model = fit(training_rows(docs, labels))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (hash_rest("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
