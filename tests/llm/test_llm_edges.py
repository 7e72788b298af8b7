"""Odd rows, empty tables and clashing columns through every operator."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import html, imatch, langid, pareto, pii, simhash, suffix, toxicity, warc, winnow

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = "digest key words grams prints fp id code place part guest hash bucket rank copies size taken score predicted base found value kind start".split()
LONG = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta", "ünï", "x1"], k=60_000))
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 3), (4, LONG, "en", "b", len(LONG)),
    (5, "the same text twice over", "en", "b", 24), (5, "the same text twice over", "en", "b", 24), (5, "same id, other text", "de", "b", 19),
    (None, "no id here", "en", None, 10), (-7, "mail me at a.b@c.example.org now", "en", "c", 32), (2**62 + 7, "***", "en", "é", 3),
    (8, LONG, "fr", "b", len(LONG)), (9, "\U0001d400​idi0t а", "en", "\U0001f600", 9),
]
LABELS = [(1, 0, 1), (2, 1, 0), (3, 1, 0), (4, 1, 0), (5, 1, 1), (6, None, None), (None, 1, 1)]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.select("*", *(F.lit("clash").alias(c) for c in CLASHES))


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(0, None, 1), (1, "", 1), (2, "the same text", 1), (3, LONG[:300], 1), (3, LONG[:300], 1), (None, "no id here", 1)], "item_id bigint, text string, words int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


def test_mixing(odd, none):
    got = pareto.mix_sources(odd).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, pareto.mix_sources(odd.repartition(5)).collect()), key=str)
    assert pareto.mix_sources(none).count() == 0
    assert {r.taken for r in pareto.mix_sources(odd.where("doc_id = 2")).collect()} == {0}


def test_targets_reshare_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 30), (None, 500)], "source string, source_size bigint")
    got = {r.source: r.target for r in pareto.source_targets(sizes, (3, 1, 2), 1.5, 2.0).collect()}
    weights, most = {"a": 3, "b": 1, "c": 2, None: 3}, {"a": 20, "b": 2000, "c": 60, None: 1000}
    want, left, open_ = {}, 1.5 * 1540, dict(weights)
    while open_:
        level = left / sum(open_.values())
        over = [s for s in open_ if open_[s] * level > most[s]]
        if not over:
            want |= {s: w * level for s, w in open_.items()}
            break
        for s in over:
            want[s] = most[s]
            left -= most[s]
            del open_[s]
    assert got == pytest.approx(want)


def test_pii(odd, none):
    got = pii.find_pii(odd).collect()
    assert len(got) == len(ROWS) and {r.doc_id: r.spans for r in got}[-7] == "email:11:28"
    assert pii.find_pii(none).count() == 0
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == len(ROWS)
    row = out.where("doc_id = -7").first()
    assert row.text == "mail me at [email] now" and row.n_chars == len(row.text)


def test_contamination(odd, none, items):
    got = winnow.contamination(odd, items).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[5, 5].n_hit == 3 and by[5, 5].n_items == 1 and by[None, 3].n_hit == 3 and by[1, 0].n_hit == 0
    assert by[4, 60_000].contaminated
    assert winnow.contamination(odd, items.where("false")).where("contaminated").count() == 0
    assert winnow.contamination(none, items).count() == 0
    assert winnow.drop_contaminated(odd, items).columns == odd.columns


def test_toxicity(odd, none, labels):
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(odd, labels.where("false")).count() == len(ROWS)


def test_repeats(odd, none):
    got = {(r.doc_id, r.n_words): r.n_removed for r in suffix.drop_repeated_spans(odd).collect()}
    assert got[8, 60_000] == 60_000 and got[4, 60_000] == 0 and suffix.drop_repeated_spans(odd).count() == len(ROWS)
    assert suffix.drop_repeated_spans(none).count() == 0
    spans = sorted((r.doc_id, r.first_word, r.n_words) for r in suffix.maximal_repeats(odd).collect())
    assert spans == [(4, 0, 60_000), (8, 0, 60_000)] and suffix.maximal_repeats(none).count() == 0


def test_imatch(odd, none):
    got = imatch.fingerprint_edits(odd).collect()
    assert len(got) == len(ROWS)
    assert len({r.fingerprint for r in got if r.n_chars == len(LONG)}) == 1
    assert imatch.fingerprint_edits(none).count() == 0
    alone = imatch.fingerprint_edits(odd.where("doc_id = 4")).first()
    assert alone.near_next == 1.0


def test_language(odd, none):
    got = langid.language_of(odd).collect()
    assert len(got) == len(ROWS) and {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 2**62 + 7)} == {"und"}
    assert langid.language_of(none).count() == 0
    assert {r.lang_pred for r in langid.language_of(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_simhash(odd, none):
    got = simhash.near_duplicate_groups(odd).collect()
    assert len(got) == len(ROWS)
    groups = {(r.id, r.fp): r.component for r in got}
    assert len({c for (i, fp), c in groups.items() if i in (1, 2, 3) and fp == 0}) == 1
    assert simhash.near_duplicate_groups(none).count() == 0
    kept = simhash.keep_one_of_each_group(odd)
    assert kept.columns == odd.columns and kept.where("text = 'the same text twice over'").count() == 1


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>unclosed <b>one"), (3, "u", "<p>unclosed <b>one"), (None, "u", "plain"), (5, "u", "<" * 3000 + "a b='" * 200),
            (6, "u", "<article><p>" + "word, word. " * 20_000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = html.main_text(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert html.main_text(pages.where("false")).count() == 0
    whole = {r.page_id: r.n_chars for r in html.main_text(pages).collect()}
    assert whole[6] > 200_000 and whole[2] == 0
    assert html.main_text(pages, most=3, chars=1).count() == len(rows)     # the shortest page is learned from all the same
    assert whole[6] > 200_000 and whole[2] == 0
    back = warc.archive_round_trip(pages).collect()
    assert len(back) == len(rows)
    assert {(r.page_id, r.record_type) for r in back if r.payload_bytes == 0} == {(1, "revisit"), (2, "response")}
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_stages_keep_columns_and_clean_rows(spark, odd, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.where("item_id = 1").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "mixing":
            assert docs.columns == odd.columns, name
            assert docs.where("doc_id = -7").count() == 1, name
    assert docs.where("doc_id = -7").count() == 1
