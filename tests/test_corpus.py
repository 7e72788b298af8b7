"""Cleaning and de-duplication rules on small hand-made rows."""

import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions import text as T
from corpusmill.functions.accents import fold, strip_accents
from corpusmill.operators import corpus as C
from corpusmill.sources import readers as R

SCHEMA = "doc_id long, title string, text string, subject string, date string, label int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def contents(df):
    return {r.doc_id: r.content for r in df.collect()}


def test_null_title_and_text_become_empty(spark):
    df = rows(spark, (1, None, "Body", "s", "d", 0), (2, "Head", None, "s", "d", 1), (3, None, None, None, None, 1))
    assert contents(C.clean_frame(df)) == {1: "body", 2: "head", 3: ""}
    assert contents(C.prepare_corpus(df)) == {1: "body", 2: "head"}


@pytest.mark.parametrize("raw, cleaned", [
    ("See https://a.b/c?d=1). End", "see ). end"),
    ("mail me.now@site.co.uk!", "mail !"),
    ("WWW.Site.COM and x", "and x"),
    ("a\t\n  b c", "a b c"),
    ("nothing", "nothing"),
])
def test_clean_text(spark, raw, cleaned):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(T.clean_text(F.col("t"))).first()[0] == cleaned


def test_flags_switch_steps_off(spark):
    df = spark.createDataFrame([("A  http://x.y b",)], "t string")
    off = FeatureConfig(lowercase=False, remove_urls_emails=False, normalize_whitespace=False)
    assert df.select(T.clean_text(F.col("t"), off)).first()[0] == "A  http://x.y b"


def test_duplicate_across_classes_keeps_class_zero(spark):
    df = rows(spark, (1, "t", "same", "s", "d", 1), (9, "T", "Same", "s", "d", 0), (3, "t", "other", "s", "d", 1))
    kept = {(r.doc_id, r.label) for r in C.prepare_corpus(df).collect()}
    assert kept == {(9, 0), (3, 1)}


def test_subject_is_part_of_the_key_only_when_enabled(spark):
    df = rows(spark, (1, "t", "x", "news", "d", 1), (2, "t", "x", "politics", "d", 1))
    assert C.prepare_corpus(df).count() == 1
    assert C.prepare_corpus(df, FeatureConfig(include_subject=True)).count() == 2


def test_one_text_in_a_third_of_the_rows(spark):
    base = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("title"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("s").alias("subject"), F.lit("d").alias("date"), F.lit(1).alias("label"))
    for parts in (1, 7):
        kept = C.prepare_corpus(base.repartition(parts))
        assert kept.count() == 2001
        assert kept.where("content = 't hot'").first().doc_id == 0


def test_required_columns(spark):
    df = rows(spark, (1, "a", "b", "c", "d", 0))
    with pytest.raises(ValueError, match="text"):
        C.require_columns(df.drop("text"))
    with pytest.raises(ValueError, match="subject"):
        C.require_columns(df.drop("subject"), FeatureConfig(include_subject=True))


def test_inference_cleaning_keeps_every_row(spark):
    df = rows(spark, (1, "a", "b", "c", "d", 0), (2, "a", "b", "c", "d", 0), (3, "", "", "c", "d", 0))
    assert C.clean_frame(df).count() == 3


def test_word_count_and_preview(spark):
    df = spark.createDataFrame([("",), ("a b  c",), ("x" * 201,)], "t string")
    got = [tuple(r) for r in df.select(T.word_count(F.col("t")), F.length(T.preview(F.col("t")))).collect()]
    assert got == [(0, 0), (3, 6), (1, 203)]


def test_accents_follow_the_unicode_rule(spark):
    text = "Résumé Ångström naïve Ελλάδα й ﬁ ½ é plain"
    df = spark.createDataFrame([(text,), ("ascii",)], "t string")
    for mode in ("unicode", "unicode_full"):
        assert [r[0] for r in df.select(strip_accents(F.col("t"), mode)).collect()] == [fold(text), "ascii"]


def test_every_code_point_folds_like_nfkd(spark):
    points = [p for p in range(1, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF and unicodedata.category(chr(p)) != "Cn"]
    points = [p for p in points if fold(chr(p)) != chr(p) or p % 97 == 0]
    df = spark.createDataFrame([(p, f"a{chr(p)}z") for p in points], "p int, t string").select("p", strip_accents(F.col("t"), "unicode").alias("f"))
    wrong = [r.p for r in df.collect() if r.f != "a" + fold(chr(r.p)) + "z"]
    assert wrong == []


def test_duplicates_keep_odd_ids_and_missing_labels(spark):
    odd = [(-5, 0), (2**62 + 7, 0), (-(2**63), 1), (7, 1), (8, None)]
    df = rows(spark, *[(i, "t", f"text {i}", "s", "d", label) for i, label in odd], (9, "t", "text 8", "s", "d", 1), (10, "t", "text 8", "s", "d", None))
    assert {(r.doc_id, r.label) for r in C.prepare_corpus(df).collect()} == {(-5, 0), (2**62 + 7, 0), (-(2**63), 1), (7, 1), (9, 1)}


def test_rows_without_a_text_go_only_if_gaps_are_not_filled(spark):
    df = rows(spark, (1, None, "Body", "s", "d", 0), (2, "Head", "x", "s", "d", 1))
    assert contents(C.prepare_corpus(df, FeatureConfig(fill_missing_with_empty=False))) == {2: "head x"}


def test_files_are_numbered_by_path_not_by_size(spark, tmp_path):
    for label, side in enumerate(("zero", "one")):
        (tmp_path / side).mkdir()
        for name, n in (("a", 3), ("b", 4000), ("c", 40)):
            (tmp_path / side / f"{name}.csv").write_text("title,text,subject,date\n" + "".join(f"{side}{name}{i},x,s,d\n" for i in range(n)))
    want = [f"{side}{name}{i}" for side in ("zero", "one") for name, n in (("a", 3), ("b", 4000), ("c", 40)) for i in range(n)]
    for _ in range(2):
        got = R.load_labelled_pair(spark, str(tmp_path / "zero"), str(tmp_path / "one")).orderBy("doc_id").collect()
        assert [r.title for r in got] == want and [r.doc_id for r in got] == list(range(len(want)))


def test_built_in_folding_is_exact_on_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    differs = docs.where(strip_accents(F.col("text"), "unicode") != strip_accents(F.col("text"), "unicode_full"))
    assert differs.count() == 0


def test_stop_words_go_before_bigrams(spark):
    from corpusmill.operators.terms import postings
    df = spark.createDataFrame([(1, "state of the union state of the union")], "doc_id long, content string")
    got = {r.term: r.tf for r in postings(df).collect()}
    assert got == {"state": 2, "union": 2, "state union": 2, "union state": 1}


def test_csv_pair_with_newlines_and_quotes(spark, tmp_path):
    (tmp_path / "zero.csv").write_text('title,text,subject,date\n"A ""q""","line1\nline2",s,d\n')
    (tmp_path / "one.csv").write_text("title,text,subject,date\nB,,s,d\n")
    pair = R.load_labelled_pair(spark, str(tmp_path / "zero.csv"), str(tmp_path / "one.csv")).orderBy("doc_id").collect()
    assert [(r.title, r.text, r.label) for r in pair] == [('A "q"', "line1\nline2", 0), ("B", None, 1)]


def test_optional_label_names(spark, tmp_path):
    (tmp_path / "t.csv").write_text("title,text,target\na,b,1\n")
    (tmp_path / "n.csv").write_text("title,text\na,b\n")
    assert R.load_csv_optional_label(spark, str(tmp_path / "t.csv")).first().label == 1
    assert "label" not in R.load_csv_optional_label(spark, str(tmp_path / "n.csv")).columns


def test_only_labelled_texts_are_dealt(spark, tmp_path):
    from corpusmill.plans import inputs as I
    spark.createDataFrame([(i, f"t{i}\nbody", "src1", "en") for i in range(6)], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (4, 0), (4, 1), (9, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    df = I.labelled(spark, str(tmp_path))
    assert sorted((r.doc_id, r.title, r.text, r.subject, r.lang, r.date, r.label) for r in df.collect()) == [
        (1, "t1", "body", "src1", "en", "1", 1), (4, "t4", "body", "src1", "en", "4", 0), (4, "t4", "body", "src1", "en", "4", 1)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression") < plan.index("Join")     # the join is below


@pytest.mark.parametrize("text", ["a@b.co x", "WWW.x.org y", "HTTPS://q.r s", "http\u017f://q.r s", "plain words", "x@y", "", None, "see http://a.b. End"])
def test_texts_without_links_skip_the_pattern(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    same = T.strip_urls_emails(F.col("t")).eqNullSafe(F.regexp_replace("t", F.lit("(?iU)" + T.URL_EMAIL), F.lit(" ")))
    out = df.select(same.alias("same"), T.strip_urls_emails(F.col("t")).alias("out"))
    assert out.first().same and "CASE WHEN" in out._jdf.queryExecution().analyzed().toString()


def test_grams_are_sorted_natively(spark):
    from corpusmill.operators.terms import postings
    df = postings(spark.createDataFrame([(1, "b\u00e9e aa b\u00e9e zz aa")], "doc_id long, content string"))
    assert "array_sort" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert {r.term: r.tf for r in df.collect() if " " not in r.term} == {"aa": 2, "bee": 2, "zz": 1}
