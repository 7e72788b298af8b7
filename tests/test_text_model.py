"""Models of raw text, the comparison of configurations, timed tuning, streams that start again."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from corpusmill.config import SVM_CONFIGS, FeatureConfig
from corpusmill.operators import linear as G
from corpusmill.operators import selection as L
from corpusmill.operators import textmodel as T
from corpusmill.operators import tfidf as V
from corpusmill.operators.corpus import prepare_corpus
from corpusmill.operators.vectors import vector_frame
from corpusmill.session import materialize
from corpusmill.streaming import scoring as W

CONFIG = FeatureConfig()
SCHEMA = "doc_id long, title string, text string, subject string, date string, label int"
GOOD, BAD = "river meadow forest spring", "market bank credit loan"


def records(spark, n=40):
    data = [(i, None if i == 3 else f"note {i % 5}", (GOOD if i % 2 else BAD) + f" word{i % 7} item{i % 3}", "s", "d", i % 2) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def fitted(spark):
    train = materialize(prepare_corpus(records(spark)), "train")
    features = V.FittedFeatures(CONFIG, materialize(V.fit_vocabulary(train, CONFIG), "vocab"))
    size = features.vocab.count()
    rows = materialize(V.sparse_rows(train, features.transform(train), "label"), "rows")
    return features, size, rows, vector_frame(rows, size), rows.count()


@pytest.mark.parametrize("config", [{"kernel": "linear"}, {"kernel": "linear", "balanced": True}, {"kernel": "rbf"}, {"kernel": "poly", "degree": 4}, {"kernel": "sigmoid"}],
                         ids=lambda c: c["kernel"] + ("_balanced" if "balanced" in c else ""))
def test_a_loaded_model_scores_alike(spark, fitted, tmp_path, config):
    features, size, rows, vectors, n = fitted
    model = T.fit_svm(config, features, rows, vectors, n, size)
    model.save(str(tmp_path / "m"), name="x")
    loaded, meta = T.load_text_model(spark, str(tmp_path / "m"))
    assert meta["name"] == "x" and meta["size"] == size
    got, want = ({r.doc_id: r for r in m.score(records(spark)).collect()} for m in (loaded, model))
    assert len(got) == 40 and got.keys() == want.keys()
    assert all(got[i].score == pytest.approx(want[i].score, abs=1e-9) and got[i].pred == want[i].pred for i in got)
    assert all(got[i].pred == i % 2 for i in got)


def test_rows_are_scored_one_by_one(spark, fitted):
    features, size, rows, vectors, n = fitted
    model = T.fit_svm({"kernel": "linear"}, features, rows, vectors, n, size)
    odd = spark.createDataFrame([(1, "a", GOOD, "s", "d", 1), (2, "a", GOOD, "s", "d", 0), (2, "a", GOOD, "s", "d", 0)], SCHEMA)
    assert sorted(r.label for r in model.score(odd.limit(2)).collect()) == [0, 1]      # equal texts both stay
    bare = spark.createDataFrame([(1, None, None), (2, "", ""), (3, "unknown", "terms only")], "doc_id long, title string, text string")
    got = model.score(bare).collect()
    assert {r.doc_id for r in got} == {1, 2, 3} and all(r.label is None for r in got)
    assert len({r.score for r in got}) == 1                                          # the intercept alone
    assert model.score(records(spark).limit(0)).count() == 0


def test_comparison_keeps_the_order_given(spark, fitted):
    features, size, rows, vectors, n = fitted
    table = L.multi_config_compare(list(SVM_CONFIGS), lambda c: T.fit_svm(c, features, rows, vectors, n, size), lambda m: m.classify(rows, vectors),
                                   lambda m: m.score(records(spark)), spark, parallelism=3)
    got = table.orderBy("run_no").collect()
    assert [r.config_name for r in got] == [c["name"] for c in SVM_CONFIGS] and len(got) == 10
    assert all(r.n_internal == n and r.n_external == 40 and r.training_time > 0 for r in got)
    assert all(r.external_acc == 1.0 and r.auc_score == 1.0 for r in got)
    winners = L.leaderboard(table.withColumn("accuracy", F.col("external_acc")))
    assert {r.criterion: r.config_name for r in winners.collect()}["best_accuracy"] == "Linear_C1"


def test_tuner_keeps_the_seconds_of_each_fit(spark, fitted):
    vectors = fitted[3].withColumn("fold", (F.col("doc_id") % 2).cast("int"))
    tuned = L.cross_validated(vectors, LogisticRegression(maxIter=3), {"regParam": [0.01, 1.0]}, L.SpecificityEvaluator(), k=2, parallelism=2)
    seconds = [r.fit_seconds for r in tuned.table.collect()]
    assert len(seconds) == 4 and all(s > 0 for s in seconds) and len(set(seconds)) == 4
    best = [r for r in tuned.table.collect() if r.setting == tuned.best]
    row = L.search_summary(tuned).first()
    assert row.n_folds == 2 and row.mean_fit_time == pytest.approx(sum(r.fit_seconds for r in best) / 2)
    assert row.mean_score == pytest.approx(sum(r.test_score for r in best) / 2)


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"c{i % 4}", i // 4) for i in range(16)], "doc_id long, content string, part int")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    parts = [rows.where(F.col("part") == p).drop("part") for p in range(4)]
    progress = W.run_arrivals(spark, [*parts, rows.limit(0).drop("part")], str(tmp_path / "in"),
                              lambda stream: W.append_to(W.stream_dedup(stream), out, checkpoint))
    assert sorted(r.content for r in spark.read.parquet(out).collect()) == ["c0", "c1", "c2", "c3"]
    assert {r.doc_id for r in spark.read.parquet(out).collect()} == {0, 1, 2, 3}
    assert [p.state_rows for p in progress[:4]] == [4, 4, 4, 4]
