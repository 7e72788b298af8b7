"""Benchmark decontamination by winnowing, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.llm.common import broadcast_measured, materialize

SPAN = 10          # words of a window: every shared span of this length is found
GRAM = 5           # words of a hashed k-gram
WINDOW = SPAN - GRAM + 1   # k-grams of which the smallest hash is kept
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words of a text column: A-Z lowered, runs of digits, a-z and everything beyond ASCII; null has none."""
    t = F.coalesce(F.col(text), F.lit(""))
    lowered = F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _each_from(n: Column, length: int, fn) -> Column:
    """``fn(i)`` for each 1-based start of a run of ``length`` among ``n``; nothing where ``n`` is less."""
    return F.when(n >= length, F.transform(F.sequence(F.lit(1), n - (length - 1)), fn))


def _gram_hashes(words: str, length: int) -> Column:
    return _each_from(F.size(words), length, lambda i: F.xxhash64(F.slice(words, i, length)))


def _with_hashes(df: DataFrame, short_lengths: list[int]) -> DataFrame:
    """Adds ``grams`` and ``prints``: what winnowing keeps, and all n-grams of the lengths of short items."""
    df = df.withColumn("grams", _gram_hashes("words", GRAM))
    least = _each_from(F.size("grams"), WINDOW, lambda i: F.array_min(F.slice("grams", i, WINDOW)))
    nothing = F.array().cast("array<bigint>")
    parts = [F.coalesce(least, nothing), *(F.coalesce(_gram_hashes("words", n), nothing) for n in short_lengths)]
    return df.withColumn("prints", F.array_distinct(F.concat(*parts)))


def _window_texts(words: str, length: int, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.lit(length).alias("len"), F.array_join(F.slice(words, i, length), " ").alias("words")))


def _matched_starts(length: int) -> Column:
    return F.filter(F.sequence(F.lit(1), F.size("words") - (length - 1)),
                    lambda i: F.array_contains("matched", F.xxhash64(F.slice("words", i, length))))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(item, len, words): every window of every item; an item shorter than a window is one window."""
    tokens = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of("text").alias("words"))
    length = F.least(F.size("words"), F.lit(SPAN))
    spans = tokens.where(F.size("words") > 0).withColumn("len", length).withColumn(
        "start", F.explode(F.expr("sequence(1, size(words) - len + 1)")))
    return spans.select("item", "len", F.array_join(F.expr("slice(words, start, len)"), " ").alias("words")).distinct()


def _digest() -> Column:
    return F.md5(F.coalesce("text", F.lit("")))


def text_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(digest, n_hit, n_items, items_sha256) of the distinct texts that share a span with an item; written.

    1. Both sides keep the smallest hash of every ``WINDOW`` consecutive
       ``GRAM``-grams. Equal spans of ``SPAN`` words hold equal k-grams, so
       they keep an equal hash: the equality join on kept hashes misses none.
       Items shorter than a window look for their own length instead.
    2. Around each matched k-gram the hit is extended to the windows that hold
       it, and a window counts only if its words are equal.
    3. Words in the union of those windows are hit.

    The second step runs once per distinct text. The corpus is not shuffled:
    rows carry a digest, and only texts with a matched hash move. Hashes of the
    items are broadcast if their counted rows are few; otherwise Spark joins by
    shuffle. Texts and items that are null or have no word give no hit, null
    item ids count as one item named by the empty text, an empty ``items``
    gives zero everywhere, other columns are ignored, and repeated rows stay.
    """
    windows = materialize(benchmark_windows(items), "bench-windows")
    short = sorted(r[0] for r in windows.where(F.col("len") < SPAN).select("len").distinct().collect())  # 9 at most
    item_words = windows.select(F.split("words", " ").alias("words"))
    # Of a long item, what winnowing keeps over all its windows is what it keeps in each of them.
    bench_prints = materialize(
        _with_hashes(item_words.where(F.size("words") == SPAN), []).select(F.explode_outer("prints").alias("print"))
        .unionByName(item_words.where(F.size("words") < SPAN).select(F.xxhash64("words").alias("print"))).distinct(),
        "bench-prints")

    texts = docs.select("text", _digest().alias("digest"))
    tokens = texts.withColumn("words", words_of("text"))
    # explode() would add a filter on the array's size, which computes all hashes once more below.
    found = (_with_hashes(tokens.select("digest", "words"), short).select("digest", F.explode_outer("prints").alias("print"))
             .join(broadcast_measured(bench_prints, 16), "print"))
    matched = materialize(found.groupBy("digest").agg(F.collect_set("print").alias("matched")), "matched-texts")

    few = broadcast_measured(matched.select("digest"), 64)
    suspects = texts.select("digest", "text").join(few, "digest", "semi").dropDuplicates(["digest"]).join(matched, "digest")
    suspects = suspects.withColumn("words", words_of("text")).withColumn("grams", _gram_hashes("words", GRAM))
    nothing = F.array().cast("array<struct<start:int,len:int,words:string>>")
    # A window that starts at i holds the k-grams i to i + WINDOW - 1.
    # Both columns are named twice here: one named once is computed anew for every i.
    around = F.filter(F.sequence(F.lit(1), F.size("grams") - (WINDOW - 1)),
                      lambda i: F.arrays_overlap(F.slice("grams", i, WINDOW), F.col("matched")))
    spans = [F.when(F.size("words") >= SPAN, _window_texts("words", SPAN, around))]
    spans += [F.when(F.size("words") >= n, _window_texts("words", n, _matched_starts(n))) for n in short]
    extended = suspects.select("digest", F.explode_outer(F.concat(*(F.coalesce(s, nothing) for s in spans))).alias("s")).select("digest", "s.*")
    hits = materialize(extended.join(windows.select("len", "words").distinct(), ["len", "words"]), "window-hits")

    covered = hits.selectExpr("digest", "start", "start + len AS stop").selectExpr(
        "digest", "stop - greatest(start, coalesce(max(stop) OVER (PARTITION BY digest ORDER BY start, stop "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start)) AS fresh")
    n_hit = covered.groupBy("digest").agg(F.sum(F.greatest("fresh", F.lit(0))).alias("n_hit"))
    named = hits.select("digest", "len", "words").distinct().join(windows, ["len", "words"]).groupBy("digest").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    return materialize(n_hit.join(named, "digest").select(
        "digest", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "text-hits")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs`` (see ``text_hits``)."""
    per_text = text_hits(docs, items)
    return (docs.select("doc_id", _digest().alias("digest"), F.size(words_of("text")).cast("bigint").alias("n_words"))
            .join(per_text, "digest", "left").select(
                "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
                F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                F.col("n_hit").isNotNull().alias("contaminated")))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text shares a span with an item; columns stay as they are."""
    hit = text_hits(docs, items).select(F.col("digest").alias("__digest"))
    return docs.join(broadcast_measured(hit, 64), _digest() == F.col("__digest"), "anti")


CONTAMINATION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
 b AS (SELECT coalesce(item_id::VARCHAR, '') AS item,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
 bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
        SELECT item, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
 dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
        SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
 hit AS (SELECT dw.rid, dw.i, dw.n, bw.item FROM dw JOIN bw USING (n, s)),
 words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)) GROUP BY rid),
 items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""
