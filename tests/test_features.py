"""TF-IDF, scaling, encoding and Naive Bayes against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.config import FeatureConfig, feature_config_from_json, feature_config_to_json, load_linear_config
from corpusmill.operators import naive_bayes as N
from corpusmill.operators import tfidf as V
from corpusmill.operators.scaling import apply_normalization, fit_normalization
from corpusmill.operators.validation import validate_features
from corpusmill.operators.vectors import vector_frame

TEXTS = [(1, "apple banana apple", 0), (2, "banana cherry", 0), (3, "apple cherry cherry date", 1),
         (4, "date date banana", 1), (5, "cherry apple", 1)]
LOOSE = FeatureConfig(min_df=1, max_df=1.0, ngram_max=1)


def docs(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "doc_id long, content string, label int")


def dense(weights, n_docs, size):
    x = np.zeros((n_docs, size))
    for r in weights.collect():
        x[r.doc_id - 1, r.term_idx] = r.weight
    return x


def reference_tfidf(rows=TEXTS):
    terms = sorted({t for _, text, _ in rows for t in text.split()})
    tf = np.array([[text.split().count(t) for t in terms] for _, text, _ in rows], float)
    idf = np.log((1 + len(rows)) / (1 + (tf > 0).sum(axis=0))) + 1
    w = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) * idf
    return w / np.linalg.norm(w, axis=1, keepdims=True)


def test_weights_equal_numpy(spark):
    d = docs(spark)
    vocab = V.fit_vocabulary(d, LOOSE)
    x = dense(V.tfidf_transform(d, vocab, LOOSE), 5, vocab.count())
    assert np.allclose(x, reference_tfidf())


def test_document_frequency_limits(spark):
    d = docs(spark, [(1, "aa bb", 0), (2, "aa cc", 1), (3, "aa bb", 1)])
    got = {r.term for r in V.fit_vocabulary(d, FeatureConfig(ngram_max=1, min_df=2, max_df=0.95)).collect()}
    assert got == {"bb"}


def test_vocabulary_cap_breaks_ties_by_name(spark):
    d = docs(spark, [(1, "zz aa mm", 0), (2, "zz", 1)])
    got = [r.term for r in V.fit_vocabulary(d, FeatureConfig(ngram_max=1, min_df=1, max_df=1.0, max_features=2)).collect()]
    assert sorted(got) == ["aa", "zz"]


def test_unknown_tokens_only_gives_an_empty_row(spark):
    d = docs(spark)
    vocab = V.fit_vocabulary(d, LOOSE)
    new = docs(spark, [(8, "unseen words", 0), (9, "apple", 1)])
    rows = {r.doc_id: r for r in V.sparse_rows(new, V.tfidf_transform(new, vocab, LOOSE)).collect()}
    assert rows[8].idx == [] and rows[9].val == [1.0]
    vectors = {r.doc_id: r.features for r in vector_frame(
        V.sparse_rows(new, V.tfidf_transform(new, vocab, LOOSE)), vocab.count()).collect()}
    assert vectors[8].numNonzeros() == 0 and vectors[9].size == vocab.count()


def test_scale_is_population_deviation_and_keeps_constants(spark):
    w = spark.createDataFrame([(1, 0, 2.0), (2, 0, 2.0), (1, 1, 1.0)], "doc_id long, term_idx int, weight double")
    got = {r.term_idx: r.scale for r in V.fit_scale(w, 2).collect()}
    assert got[0] == 1.0 and math.isclose(got[1], 0.5)


def test_normalization_guards_zero_range(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    for method, first in (("standardize", -1.0), ("minmax", 0.0)):
        params = fit_normalization(df, ["a", "b"], method)
        row = apply_normalization(df, params).orderBy("a").first()
        assert (row.a, row.b) == (first, 0.0)
    with pytest.raises(ValueError):
        fit_normalization(df, ["a"], "other")


def test_unknown_subject_is_all_zeros(spark):
    fit = spark.createDataFrame([(1, "b"), (2, "a")], "doc_id long, subject string")
    new = spark.createDataFrame([(3, "b"), (4, "zzz")], "doc_id long, subject string")
    got = [(r.doc_id, r.subject_idx) for r in V.subject_onehot(new, V.fit_subjects(fit)).collect()]
    assert got == [(3, 1)]


def numpy_nb(x, y, kind, alpha):
    """Joint log likelihoods by the textbook formulas."""
    out = []
    for c in (0, 1):
        prior = np.log((y == c).mean())
        if kind == "MNB":
            f = x[y == c].sum(axis=0) + alpha
            out.append(x @ np.log(f / f.sum()) + prior)
        elif kind == "CNB":
            f = x[y != c].sum(axis=0) + alpha
            out.append(-(x @ np.log(f / f.sum())))
        else:
            p = ((x[y == c] > 0).sum(axis=0) + alpha) / ((y == c).sum() + 2 * alpha)
            b = (x > 0).astype(float)
            out.append(b @ np.log(p) + (1 - b) @ np.log(1 - p) + prior)
    return out[1] - out[0]


@pytest.mark.parametrize("kind", N.KINDS)
@pytest.mark.parametrize("alpha", [0.1, 1.0])
def test_naive_bayes_equals_numpy(spark, kind, alpha):
    d = docs(spark)
    vocab = V.fit_vocabulary(d, LOOSE)
    weights = V.tfidf_transform(d, vocab, LOOSE, "label")
    scorer = N.fit_nb(weights, d, vocab, kind, alpha)
    got = {r.doc_id: r.margin for r in N.predict_nb(d, weights, scorer, 100).collect()}
    want = numpy_nb(reference_tfidf(), np.array([r[2] for r in TEXTS]), kind, alpha)
    assert np.allclose([got[i + 1] for i in range(5)], want)


def test_cross_validation_equals_refitting(spark):
    d = docs(spark, [(i, t, c) for i, (_, t, c) in enumerate(TEXTS * 3, 1)]).withColumn("fold", (F.col("doc_id") % 3).cast("int"))
    vocab = V.fit_vocabulary(d, LOOSE)
    weights = V.tfidf_transform(d, vocab, LOOSE, "label", "fold")
    got = {(r.doc_id, r.kind): r.margin for r in N.cv_scores(d, weights, [0.5], k=3).collect()}
    for kind in N.KINDS:
        for fold in range(3):
            scorer = N.fit_nb(weights.where(F.col("fold") != fold), d.where(F.col("fold") != fold), vocab, kind, 0.5)
            held = d.where(F.col("fold") == fold)
            for r in N.predict_nb(held, weights, scorer, 100).collect():
                assert math.isclose(got[(r.doc_id, kind)], r.margin, abs_tol=1e-9)


def test_validation_reports_bad_input(spark):
    d = spark.createDataFrame([(1, "train", 0), (2, "test", 5)], "doc_id long, split string, label int")
    w = spark.createDataFrame([(1, "train", 0, float("nan"))], "doc_id long, split string, term_idx int, weight double")
    got = {r.check: r.passed for r in validate_features(d, w, 10).collect()}
    assert not got["labels_binary"] and not got["all_finite"] and not got["test_not_empty"] and got["train_not_empty"]


def test_configs_round_trip(tmp_path):
    config = FeatureConfig(max_features=7, include_subject=True)
    assert feature_config_from_json(feature_config_to_json(config)) == config
    assert load_linear_config(str(tmp_path / "none.json")).n_iterations == 1500
    (tmp_path / "c.json").write_text('{"hyperparameters": {"learning_rate": 0.2}, "training": {"random_seed": 1}}')
    got = load_linear_config(str(tmp_path / "c.json"))
    assert (got.learning_rate, got.random_seed, got.regularization) == (0.2, 1, 0.001)
    with pytest.raises(ValueError):
        FeatureConfig(scaler_with_mean=True)


def test_subject_block_at_inference_has_the_training_width(spark):
    from dataclasses import replace
    config = replace(LOOSE, include_subject=True)
    train = docs(spark).withColumn("subject", F.when(F.col("label") == 0, "news").otherwise("blog"))
    fitted = V.fit_features(train, replace(config, produce_scaled=False))
    got = {(r.doc_id, r.term_idx): r.weight for r in fitted.transform(train).where("term_idx >= 4").collect()}
    assert got == {(1, 5): 1.0, (2, 5): 1.0, (3, 4): 1.0, (4, 4): 1.0, (5, 4): 1.0}
    unknown = fitted.transform(train.withColumn("subject", F.lit("other")))
    assert unknown.where("term_idx >= 4").count() == 0
    with pytest.raises(ValueError):
        V.FittedFeatures(config, fitted.vocab).transform(train)


def test_histogram_lists_empty_bins(spark):
    from corpusmill.operators.profile import histogram
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    assert [r.n for r in histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]
    assert histogram(df.where("v < 0"), "v", 5).count() == 0


def test_vocabulary_cut_by_steps(spark):
    from corpusmill.operators.terms import count_step, top_terms
    stats = spark.range(1, 30000).select(F.col("id").cast("string").alias("term"), (F.col("id") * F.col("id") % 9973 * 7).alias("cf"))
    plain = lambda n: [tuple(r) for r in stats.orderBy(F.desc("cf"), "term").limit(n).collect()]
    assert all([tuple(r) for r in top_terms(stats, n).collect()] == plain(n) for n in (1, 7, 500, 40000))
    assert top_terms(stats.limit(0), 5).count() == 0
    counts = list(range(1, 9000)) + [2 ** k + d for k in range(14, 62) for d in (-1, 0, 1)]
    steps = [r.s for r in spark.createDataFrame([(c,) for c in counts], "cf long").select("cf", count_step(F.col("cf")).alias("s")).orderBy("cf").collect()]
    assert steps == sorted(steps) and steps[-1] < 220000


def test_text_work_is_spread_over_the_cores(spark):
    from corpusmill.config import FeatureConfig
    from corpusmill.operators import tfidf as V
    docs = spark.createDataFrame([(i, f"alpha beta word{i % 5}") for i in range(40)], "doc_id long, content string").coalesce(1)
    vocab = V.fit_vocabulary(docs, FeatureConfig(ngram_max=1))
    weights = V.tfidf_transform(docs, vocab, FeatureConfig(ngram_max=1))
    assert weights.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert weights.count() == 40 and {r.term for r in vocab.collect()} == {f"word{i}" for i in range(5)}
