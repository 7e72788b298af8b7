"""Personal data: fixed formats as seeds, and bootstrapped contextual extraction of further identifiers."""

from __future__ import annotations

import hashlib
import re
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.llm.common import broadcast_measured, map_rows, materialize, slices

KINDS = ("email", "ip", "card", "phone")
LEAST_SUPPORT = 5      # known instances of a kind that a pattern needs
SURE_PATTERN = 0.8     # share of a pattern's instances that are known to be of the kind
SURE_INSTANCE = 0.9    # confidence from which an instance counts as known

# Possessive runs match what the plain patterns match, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TOKEN = re.compile(r"[^\s,;:()\[\]{}<>\"'|]+")
# Values of several tokens. Groups of digits joined by blanks, brackets, dots and dashes; a longer group stands alone.
_GROUPS = re.compile(r"(?<![\w.+-])(?:\([\x20]?)?[0-9]{1,6}(?![0-9])(?:(?:\)[\x20.-]?|\x20?\(|\x20-\x20|[\x20.-])[0-9]{1,6}(?!\w))+")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){3,7}(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9A-Fa-f]{0,4})(?:%\w+)?(?![\w:])")
_WORDS = re.compile(r"\S+")
_SPAN = "struct<kind:int,start:int,`end`:int>"
_FOUND = "struct<kind:int,start:int,`end`:int,value:string,contexts:array<string>>"


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: at every @, the run before it and the domain after it."""
    out, at, after = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        after = found.end() if found else at + 1
        at = text.find("@", after)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points by start, then kind: the fixed formats."""
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                spans.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    spans.append((3, m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], s[0]))


def like(kind: int, value: str) -> bool:
    """Could a value be an identifier of the kind, though not in its fixed format?"""
    digits = sum("0" <= c <= "9" for c in value)
    if kind == 0:
        return "@" in value
    if kind == 1:
        return value.count(".") >= 2 and digits >= 3 or value.count(":") >= 3
    return digits >= 12 if kind == 2 else 6 <= digits <= 15 and digits * 2 >= len(value)


def _contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: one or two words before it, and one on each side."""
    left = _WORDS.findall(text[max(0, start - 60):start].lower())[-2:]
    right = _WORDS.findall(text[end:end + 30].lower())[:1]
    out = [f"{left[-1]} _"] if left else []
    if len(left) == 2:
        out.append(f"{left[0]} {left[1]} _")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans that may be identifiers, by start: grouped numbers and colon addresses between the base spans, and the tokens outside both."""
    parts, at = [], 0
    for _, a, b in base:
        if b > at:
            parts += [text[at:a], "," * (b - max(a, at))]
            at = b
    between = "".join([*parts, text[at:]])
    wide = [m.span() for m in _IP6.finditer(between)] if text.count(":") >= 3 else []
    taken = list(wide)
    for m in _GROUPS.finditer(between):
        if not any(a < m.end() and m.start() < b for a, b in taken) and any(like(k, m.group()) for k in (2, 3)) and not _TOKEN.fullmatch(m.group()):
            wide.append(m.span())
    wide.sort()
    out, i = list(wide), 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if not _DIGIT.search(m.group()) and "@" not in m.group():
            continue
        b = a + len(m.group().rstrip(".!?"))
        while i < len(wide) and wide[i][1] <= a:
            i += 1
        if i == len(wide) or wide[i][0] >= b:
            out.append((a, b))
    return sorted(out)


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """Base spans, and candidates beside them that look like identifiers (kind -1), with value and patterns."""
    if not base and not _DIGIT.search(text) and "@" not in text and text.count(":") < 3:
        return []
    out = [(k, a, b, text[a:b], _contexts(text, a, b)) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    i = 0
    for a, b in candidates(text, base):
        value = text[a:b]
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i < len(taken) and taken[i][0] < b or not any(like(k, value) for k in range(4)):
            continue
        out.append((-1, a, b, value, _contexts(text, a, b)))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, base, found) per row: base spans and occurrences of the whole text; null is empty."""
    def of_batch(batch: pa.RecordBatch) -> dict:
        texts = batch.column(2).to_pylist()
        base = [base_spans(t) for t in texts]
        found = [occurrences(t, b) for t, b in zip(texts, base)]
        return {"doc_id": batch.column(0), "digest": batch.column(1),
                "base": [[dict(zip(("kind", "start", "end"), s)) for s in b] for b in base],
                "found": [[dict(zip(("kind", "start", "end", "value", "contexts"), s)) for s in f] for f in found],
                "base_sha256": [hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in s).encode()).hexdigest() for s in base]}

    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, of_batch, f"doc_id {kind}, digest string, base array<{_SPAN}>, found array<{_FOUND}>, base_sha256 string")


def _like() -> Column:
    """``like`` of the columns kind and value, in the JVM."""
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    dots, colons = (F.length(F.regexp_replace("value", f"[^{c}]", "")) for c in (".", ":"))
    return (F.when(F.col("kind") == 0, F.contains("value", F.lit("@"))).when(F.col("kind") == 1, ((dots >= 2) & (digits >= 3)) | (colons >= 3))
            .when(F.col("kind") == 2, digits >= 12).otherwise((digits >= 6) & (digits <= 15) & (digits * 2 >= F.length("value"))))


def bootstrap(found: DataFrame) -> DataFrame:
    """(value, kind) that high-confidence patterns discover, from (kind, value, contexts) occurrences.

    Values and patterns are the two sides of a graph. A pattern's confidence
    in a kind is the known share of its distinct values; a value's is one
    minus the product of its patterns' doubts. Each round adds the values it
    is sure of to the known ones, until one adds nothing. Edges are distinct before they are counted,
    so a common word before many identifiers costs one row per value.
    """
    edges = materialize(found.select("kind", "value", F.explode("contexts").alias("pattern")).distinct(), "pii-edges")
    seeds = found.where("kind >= 0").select("value", "kind", F.lit(1.0).alias("sure"), F.lit(0).alias("round")).distinct()
    known = materialize(seeds, "pii-known")
    open_edges = materialize(edges.where("kind < 0").select("value", "pattern").join(
        known.select("value").distinct(), "value", "anti"), "pii-open")
    sizes = edges.select("value", "pattern").distinct().groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_SUPPORT)
    wide = materialize(edges.select("value", "pattern").distinct().join(sizes, "pattern"), "pii-patterns")
    for step in count(1):
        scored = wide.join(known, "value").groupBy("pattern", "kind", "n").agg(F.sum("sure").alias("known"), F.count("*").alias("support"))
        good = scored.where((F.col("support") >= LEAST_SUPPORT) & (F.col("known") / F.col("n") >= SURE_PATTERN)).select(
            "pattern", "kind", F.least(F.col("known") / (F.col("n") + 0.5), F.lit(0.999)).alias("trust"))
        doubts = open_edges.join(good, "pattern").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("sure"))
        best = doubts.where(F.col("sure") >= SURE_INSTANCE).where(_like()).groupBy("value").agg(
            F.max_by("kind", F.struct("sure", -F.col("kind"))).alias("kind"), F.max("sure").alias("sure"))
        fresh = materialize(best.join(known.where("round > 0").select("value"), "value", "anti").select(
            "value", "kind", "sure", F.lit(step).alias("round")), "pii-fresh")
        if fresh.isEmpty():
            break
        known = materialize(known.unionByName(fresh), "pii-known")
    return known.where("round > 0").select("value", "kind")


def _added(scanned: DataFrame) -> DataFrame:
    """(digest, added) of texts in which discovered values occur."""
    found = scanned.select("digest", F.explode_outer("found").alias("f")).where("f IS NOT NULL").select("digest", "f.*")
    accepted = bootstrap(found.select("kind", "value", "contexts"))
    return materialize(found.where("kind < 0").select("digest", "start", "end", "value").join(accepted, "value")
                       .groupBy("digest").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added")), "pii-added")


def _all_spans() -> Column:
    nothing = F.array().cast(f"array<{_SPAN}>")
    return F.sort_array(F.transform(F.concat(F.coalesce("base", nothing), F.coalesce("added", nothing)),
                                    lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


def _spans_of(kind: int) -> Column:
    """Number of base spans of a kind. The predicate takes the span alone: a second parameter, even a default, would be its position."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row.

    Counts and digest are of the fixed formats; spans lists those and the
    discovered ones as kind:start:end. Texts are read once and never shuffled;
    only occurrences are. Null and blank texts have no spans, equal texts have
    equal spans, repeated rows stay, no rows give no rows, other columns are
    ignored.
    """
    scanned = materialize(scan(docs), "pii-scan")
    added = _added(scanned)
    width = added.agg(F.max(F.size("added"))).first()[0] or 1
    joined = scanned.drop("found").join(broadcast_measured(added, 64 + 16 * width), "digest", "left")
    name = F.array(*map(F.lit, KINDS))
    text = F.array_join(F.transform(_all_spans(), lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")
    return joined.select("doc_id", *(_spans_of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
                         "base_sha256", text.alias("spans"))


def _redact_task(columns: list[str]):
    """Rows of ``columns`` and, last, the spans of their text."""
    def run(batches):
        for batch in slices(batches):
            texts = batch.column(columns.index("text")).to_pylist()
            for i, spans in enumerate(batch.column(len(columns)).to_pylist()):
                if spans:
                    texts[i] = replace_spans(texts[i], [(s["kind"], s["start"], s["end"]) for s in spans])
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(n).type) if n == "text" else batch.column(i)
                                              for i, n in enumerate(columns)], columns)
    return run


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; n_chars follows where there is one."""
    scanned = materialize(scan(docs), "pii-scan")
    added = _added(scanned)
    base = scanned.where("size(base) > 0").select("digest", "base").dropDuplicates(["digest"])
    spans = materialize(base.join(added, "digest", "full_outer").select(
        F.col("digest").alias("__pii_digest"), _all_spans().alias("__pii_spans")), "pii-spans")
    width = spans.agg(F.max(F.size("__pii_spans"))).first()[0] or 1
    columns = docs.columns
    rows = docs.withColumn("__pii_digest", F.md5(F.coalesce("text", F.lit("")))).join(
        broadcast_measured(spans, 64 + 16 * width), "__pii_digest", "left").drop("__pii_digest")

    out = rows.select(*columns, "__pii_spans").mapInArrow(_redact_task(columns), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out


def replace_spans(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans become one, named by the first."""
    out, at, open_until = [], 0, -1
    for kind, start, end in spans:
        if start < open_until:
            open_until = max(open_until, end)
            at = open_until
            continue
        out += [text[at:start], f"[{KINDS[kind]}]"]
        at = open_until = end
    return "".join([*out, text[at:]])
