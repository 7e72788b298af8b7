"""Descent, kernel map, saved models, fingerprints, encryption."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import kernel as R
from corpusmill.operators import linear as G
from corpusmill.operators import protect as Q
from corpusmill.sources import models as Z

RNG = np.random.default_rng(5)
X = np.where(RNG.random((40, 6)) < 0.5, RNG.random((40, 6)), 0.0)
Y = (X[:, 0] + 0.2 * RNG.random(40) > X[:, 1]).astype(int)


def rows(spark, parts=3):
    data = [(i, int(Y[i]), [int(j) for j in np.flatnonzero(X[i])], [float(v) for v in X[i][X[i] > 0]]) for i in range(40)]
    return spark.createDataFrame(data, "doc_id long, label int, idx array<int>, val array<double>").repartition(parts)


def numpy_descent(steps, lr=0.5, reg=0.1):
    w, b, costs = np.zeros(6), 0.0, []
    for i in range(steps):
        p = 1 / (1 + np.exp(-(X @ w + b)))
        w, b = w - lr * (X.T @ (p - Y) / 40 + reg / 40 * w), b - lr * (p - Y).mean()
        if i % 100 == 0:
            q = 1 / (1 + np.exp(-(X @ w + b)))
            costs.append(-(Y * np.log(q) + (1 - Y) * np.log(1 - q)).mean() + reg / 80 * w @ w)
    return w, b, costs


def test_descent_equals_numpy_and_snapshots(spark):
    df = rows(spark).persist()
    model, kept = G.logreg_gd(df, 6, 0.5, 5, 0.1, snapshots=(2, 5))
    for steps, got in kept.items():
        w, b, costs = numpy_descent(steps)
        assert np.allclose(got.weights, w) and math.isclose(got.bias, b)
    assert model.costs[0][0] == 0 and math.isclose(model.costs[0][1], numpy_descent(5)[2][0])


def test_cost_falls(spark):
    df = rows(spark, 1).persist()
    model = G.logreg_gd(df, 6, 0.5, 102, 0.01)
    assert [i for i, _ in model.costs] == [0, 100] and model.costs[1][1] < model.costs[0][1]


def test_many_runs_equal_single_ones(spark):
    df = rows(spark, 20).persist()          # more partitions than are added up by the driver
    runs = [G.DescentRun(lr, reg) for lr in (0.1, 0.5) for reg in (0.0, 1.0)]
    final, kept = G.descend(df, 6, runs, 7, (3, 7))
    for r, run in enumerate(runs):
        for n in (3, 7):
            w, b, _ = numpy_descent(n, run.learning_rate, run.regularization)
            assert np.allclose(kept[r, n].weights, w) and math.isclose(kept[r, n].bias, b) and kept[r, n].steps == n
        assert np.allclose(final[r].weights, kept[r, 7].weights)


def test_a_run_stops_by_its_gradient(spark):
    df = rows(spark).persist()
    runs = [G.DescentRun(1.0, 0.1), G.DescentRun(0.05, 0.1)]
    final, kept = G.descend(df, 6, runs, 60, (5, 60), tolerance=0.3)
    assert final[0].steps < final[1].steps <= 60 and final[0].norm <= 0.3 * final[0].first_norm
    w, b, _ = numpy_descent(final[0].steps, 1.0)
    assert np.allclose(final[0].weights, w) and np.allclose(kept[0, 60].weights, w)
    before, _, _ = numpy_descent(final[0].steps - 1, 1.0)
    p = 1 / (1 + np.exp(-(X @ before + numpy_descent(final[0].steps - 1, 1.0)[1])))
    norm = np.sqrt(((X.T @ (p - Y) / 40 + 0.1 / 40 * before) ** 2).sum() + (p - Y).mean() ** 2)
    assert norm > 0.3 * final[0].first_norm


def test_a_descent_goes_on_from_its_state(spark, tmp_path):
    df, runs = rows(spark).persist(), [G.DescentRun(0.5, 0.1), G.DescentRun(2.0, 0.1)]
    whole, kept = G.descend(df, 6, runs, 130, (40, 130), tolerance=0.05)
    path = f"file://{tmp_path}/state"
    G.descend(df, 6, runs, 75, (40,), tolerance=0.05, state=path, every=50)     # ends as if its driver had been lost
    (tmp_path / "state/step-00000060").mkdir()                                   # a save that was broken off
    again, kept_again = G.descend(df, 6, runs, 130, (40, 130), tolerance=0.05, state=path, every=50)
    assert G.DescentState(spark, path).last()[0] == 100
    for a, b in zip([*whole, *(kept[k] for k in sorted(kept))], [*again, *(kept_again[k] for k in sorted(kept_again))]):
        assert np.allclose(a.weights, b.weights) and math.isclose(a.bias, b.bias) and a.steps == b.steps
    assert [c[0] for c in again[0].costs] == [c[0] for c in whole[0].costs] and np.allclose([c[1] for c in again[0].costs], [c[1] for c in whole[0].costs])


def test_a_step_is_one_stage_that_does_not_read_the_rows_again(spark):
    seen = spark.sparkContext.accumulator(0)
    empty = spark.createDataFrame([(40, 1, [], []), (41, 0, [], [])], "doc_id long, label int, idx array<int>, val array<double>")

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = rows(spark).unionByName(empty).mapInArrow(counted, "doc_id long, label int, idx array<int>, val array<double>")
    model = G.logreg_gd(df, 6, 0.5, 8, 0.1)
    again = G.logreg_gd(rows(spark, 40).unionByName(empty), 6, 0.5, 8, 0.1)
    assert seen.value == 42 and model.steps == 8 and np.allclose(model.weights, again.weights) and math.isclose(model.bias, again.bias)


@pytest.mark.parametrize("parts", [3, 20])
def test_whole_copies_and_sums_descend_alike(spark, monkeypatch, parts):
    df, runs = rows(spark, parts).persist(), [G.DescentRun(lr, 0.1) for lr in (0.02, 0.05, 0.1, 1.0, 2.0)]
    passes, full_pass = [], G._full_pass
    monkeypatch.setattr(G, "_full_pass", lambda *a: (passes.append(1), full_pass(*a))[1])
    whole, kept = G.descend(df, 6, runs, 40, (10, 40), tolerance=0.3, every=15)
    assert not passes                       # what a task can hold is not added up over tasks step by step
    monkeypatch.setattr(G, "_WHOLE", 0)
    summed, kept_too = G.descend(df, 6, runs, 40, (10, 40), tolerance=0.3, every=15)
    assert len(passes) == 41 and sorted(kept) == sorted(kept_too) and {m.steps < 40 for m in whole} == {True, False}
    for a, b in zip([*whole, *(kept[k] for k in sorted(kept))], [*summed, *(kept_too[k] for k in sorted(kept))]):
        assert np.allclose(a.weights, b.weights) and math.isclose(a.bias, b.bias) and a.steps == b.steps and math.isclose(a.norm, b.norm)


def test_no_run_of_the_search_ends_before_its_iterations(spark, sf_dir):
    from corpusmill.plans.catalog import QUERIES
    table = QUERIES["grid_search_holdout"](spark, sf_dir).collect()
    assert len(table) == 64 and all(r.steps == r.n_iterations for r in table)


def test_search_table_winner_and_pivots(spark):
    from corpusmill.operators import selection as L
    df = rows(spark).persist()
    space = {"learning_rate": [0.1, 1.0], "n_iterations": [2, 5], "regularization": [0.0, 10.0]}
    table = L.grid_search_holdout(df, df, 6, space).persist()
    got = {(r.learning_rate, r.n_iterations, r.regularization): r for r in table.collect()}
    assert [k for k, r in sorted(got.items(), key=lambda x: x[1].run_no)] == [(lr, n, g) for lr in (0.1, 1.0) for n in (2, 5) for g in (0.0, 10.0)]
    want = {}
    for lr, n, g in got:
        w, b, _ = numpy_descent(n, lr, g)
        want[lr, n, g] = ((X @ w + b >= 0).astype(int) == Y).mean()
        assert math.isclose(got[lr, n, g].accuracy, want[lr, n, g]) and got[lr, n, g].n_valid == 40
    best = L.best_configuration(table).first()
    top = max(want.values())
    assert best.run_no == min(r.run_no for k, r in got.items() if math.isclose(want[k], top))
    pivot = {r.learning_rate: r["5"] for r in L.param_pivot(table.withColumnRenamed("accuracy", "score"), "learning_rate", "n_iterations", [2, 5]).collect()}
    assert all(math.isclose(pivot[lr], (want[lr, 5, 0.0] + want[lr, 5, 10.0]) / 2) for lr in pivot)


def test_tuner_picks_by_a_custom_metric(spark):
    from pyspark.ml.classification import LogisticRegression
    from corpusmill.operators import selection as L
    from corpusmill.operators.vectors import vector_frame
    df = vector_frame(rows(spark), 6).withColumn("fold", (F.col("doc_id") % 2).cast("int")).persist()
    tuned = L.cross_validated(df, LogisticRegression(maxIter=5), {"regParam": [0.001, 1.0]}, L.SpecificityEvaluator(), k=2, parallelism=2)
    got = {(r.setting, r.fold): r for r in tuned.table.collect()}
    assert len(got) == 4
    means = []
    for s, reg in enumerate([0.001, 1.0]):
        for fold in (0, 1):
            model = LogisticRegression(maxIter=5, regParam=reg).fit(df.where(F.col("fold") != fold))
            for side, score in ((F.col("fold") == fold, got[s, fold].test_score), (F.col("fold") != fold, got[s, fold].train_score)):
                out = model.transform(df.where(side)).where("label = 0").agg(F.avg((F.col("prediction") == 0).cast("double"))).first()[0]
                assert math.isclose(score, out) and got[s, fold].regParam == reg
        means.append(sum(got[s, fold].test_score for fold in (0, 1)))
    assert tuned.best == int(np.argmax(means))


def test_hinge_objective(spark):
    from corpusmill.operators.vectors import vector_frame
    vectors = vector_frame(rows(spark), 6)
    model = G.svm_linear(vectors, 40, c=0.5)
    w, b = model.coefficients.toArray(), model.intercept
    margins = (X @ w + b) * (2 * Y - 1)
    want = np.maximum(0, 1 - margins).mean() + 1 / 0.5 / 40 / 2 * w @ w
    assert math.isclose(G.hinge_objective(model, vectors), want) and want < 1


def test_landmarks_cover_what_is_left(spark):
    df = rows(spark)
    coverage = R.Coverage([], [])
    R.fit_nystrom(df, 6, R.KernelSpec("rbf", 2.0), m=16, passes=4, coverage=coverage)
    assert coverage.landmarks == [0, 4, 8, 12, 16] and coverage.error[0] == 1
    assert all(a > b for a, b in zip(coverage.error, coverage.error[1:])) and coverage.error[-1] < 0.4
    whole = R.Coverage([], [])
    R.fit_nystrom(df, 6, R.KernelSpec("rbf", 2.0), m=1000, coverage=whole)
    assert whole.error[-1] < 1e-6


@pytest.mark.parametrize("spec", [R.KernelSpec("rbf", 0.7), R.KernelSpec("poly", 1.0, degree=2, coef0=1.0)])
def test_map_is_exact_with_all_rows_as_landmarks(spark, spec):
    df = rows(spark)
    mapped = {r.doc_id: r.features.toArray() for r in R.fit_nystrom(df, 6, spec, m=40).transform(df).collect()}
    phi = np.array([mapped[i] for i in range(40)])
    full = X[(X > 0).any(axis=1)]
    squares = (full ** 2).sum(axis=1)
    want = R._kernel(full @ full.T, squares, squares, spec, spec.gamma)
    keep = (X > 0).any(axis=1)
    assert np.allclose((phi @ phi.T)[np.ix_(keep, keep)], want, atol=1e-5)


def test_scale_gamma(spark):
    assert math.isclose(R.scale_gamma(rows(spark), 6), 1 / (6 * X.var()), rel_tol=1e-9)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (1,)], "label int")
    assert {r.label: r.class_weight for r in G.balanced_weights(df).collect()} == {0: 2.0, 1: 4 / 6}


def test_latest_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Z.latest_model(spark, str(tmp_path))
    import os
    for name, at in (("b_metadata.json", 1000), ("a_metadata.json", 2000)):
        (tmp_path / name).write_text("{}")
        os.utime(tmp_path / name, (at, at))
    assert Z.latest_model(spark, str(tmp_path)).endswith("a_metadata.json")


def test_sha3_known_answer(spark):
    df = spark.createDataFrame([("abc",)], "a string")
    got = df.select(Q._sha3_256("a").alias("fingerprint")).first().fingerprint
    assert got == "3a985da74fe225b2045c172d6bd390bd855f086e3e9d525b46bfe24511431532"


def test_null_is_not_missing(spark):
    df = spark.createDataFrame([("x", None, "y"), ("x", "y", None)], "a string, b string, c string")
    assert Q.row_fingerprint(df, ["a", "b", "c"]).select("fingerprint").distinct().count() == 2


@pytest.mark.parametrize("mode", ["GCM", "ECB", "CBC"])
def test_encryption_round_trip_hides_text_and_key(spark, tmp_path, mode):
    (tmp_path / "key.txt").write_text("0123456789abcdef\n")
    key = Q.key_frame(str(tmp_path / "key.txt"), spark).scalar()
    df = spark.createDataFrame([(1, "secret words"), (2, None)], "id long, t string")
    sealed = Q.encrypt_column(df, "t", key, mode)
    assert "secret" not in str([r.t for r in sealed.collect()])
    assert "0123456789abcdef" not in sealed._jdf.queryExecution().toString()
    assert [r.t for r in Q.decrypt_column(sealed, "t", key, mode).orderBy("id").collect()] == ["secret words", None]


def test_fingerprints_tell_columns_and_nulls_apart(spark):
    rows_ = [("a\u0001b", "c"), ("a", "b\u0001c"), (None, "x"), ("\u0002", "x"), ("", "x"), ("-", "x"), ("1:a", ""), ("1", "a")]
    df = spark.createDataFrame(rows_, "a string, b string")
    prints = {r.fingerprint for r in Q.row_fingerprint(df, ["a", "b"]).collect()}
    assert len(prints) == len(rows_)


def test_runs_take_their_newest_record(spark, tmp_path):
    import json
    import os
    for name, accuracy, age in (("old", 0.9, 1000), ("new", 0.5, 2000)):
        folder = tmp_path / "run" / "Trained"
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"{name}_metadata.json"
        path.write_text(json.dumps({"metrics": {"accuracy": accuracy}}))
        os.utime(path, (age, age))
    (tmp_path / "run" / "config_summary.json").write_text(json.dumps({"config_name": "run", "test_metrics": {"accuracy": 0.7}}))
    assert Z.collect_runs(spark, str(tmp_path)).first().train_metrics.accuracy == 0.5


def test_kernel_map_does_not_depend_on_blocks(spark, monkeypatch):
    data = rows(spark).unionByName(spark.createDataFrame([(99, 0, [], [])], rows(spark).schema))
    whole = {r.doc_id: list(r.features) for r in R.fit_nystrom(data, 6, R.KernelSpec("rbf"), m=8).transform(data).collect()}
    monkeypatch.setattr(R, "BLOCK_VALUES", 1)
    small = {r.doc_id: list(r.features) for r in R.fit_nystrom(data, 6, R.KernelSpec("rbf"), m=8).transform(data).collect()}
    assert whole.keys() == small.keys() and all(np.allclose(whole[i], small[i]) for i in whole)


def test_a_worker_maps_few_rows_at_once(monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace
    data = [(i, int(Y[i]), np.flatnonzero(X[i]).astype(np.int32), X[i][X[i] > 0]) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in data]), pa.array([r[1] for r in data], pa.int32()),
                                        pa.array([r[2] for r in data], pa.list_(pa.int32())), pa.array([r[3] for r in data], pa.list_(pa.float64()))], ["doc_id", "label", "idx", "val"])
    marks = X[:7].T
    shared, spec = SimpleNamespace(value=(marks, (marks ** 2).sum(axis=0), np.eye(7))), R.KernelSpec("rbf")
    tasks = [R._map_task(shared, spec, 0.5), R._residual_task(shared, spec, 0.5)]
    whole = [pa.Table.from_batches(t(iter([batch]))).to_pydict() for t in tasks]
    monkeypatch.setattr(R, "ROWS_AT_ONCE", 6)
    for task, want in zip(tasks, whole):
        parts = list(task(iter([batch])))
        assert [p.num_rows for p in parts] == [6] * 6 + [4] and pa.Table.from_batches(parts).to_pydict() == want


def test_specificity_drives_a_cross_validator(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from corpusmill.operators.selection import SpecificityEvaluator
    data = spark.createDataFrame([(int(Y[i]), [float(v) for v in X[i]], i % 3) for i in range(40)], "label int, x array<double>, fold int").select(
        "label", array_to_vector("x").alias("features"), "fold")
    lr = LogisticRegression()
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 5.0]).build()
    model = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=SpecificityEvaluator(), numFolds=3, foldCol="fold").fit(data)
    assert len(model.avgMetrics) == 2 and all(0 <= m <= 1 for m in model.avgMetrics)


def test_trees_are_sparks_and_never_see_rows_as_dense(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors
    from corpusmill.operators import trees as D
    rng = np.random.default_rng(3)
    x = np.where(rng.random((200, 5)) < 0.5, np.round(rng.random((200, 5)) * 9 - 3), 0.0)
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 1).astype(int)
    vectors = [Vectors.dense(r) if i % 7 == 0 else Vectors.sparse(5, [(j, float(v)) for j, v in enumerate(r) if v]) for i, r in enumerate(x)]
    df = spark.createDataFrame([(i, int(y[i]), v) for i, v in enumerate(vectors)], ["doc_id", "label", "features"]).repartition(3).persist()
    want = GBTClassifier(maxIter=4, maxDepth=3, stepSize=0.1, minInfoGain=1 / 200, seed=42).fit(df)
    fitted, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, rows: (fitted.append(rows.count()), fit(self, rows))[1])
    monkeypatch.setattr(D, "_LEAST", 100)        # several partitions and ranges of features
    got = D.gbt(df, 4, 3, 0.1, 1.0, 1.0)
    assert fitted == [2] and got.treeWeights == want.treeWeights and got.numFeatures == 5
    ours, theirs = ([r.probability[1] for r in m.transform(df).orderBy("doc_id").collect()] for m in (got, want))
    assert np.allclose(ours, theirs)
    drawn = D.gbt(df, 4, 3, 0.1, 0.6, 1.0)       # part of the rows per tree, and the same again
    assert drawn.featureImportances == D.gbt(df, 4, 3, 0.1, 0.6, 1.0).featureImportances
    assert np.mean([r.prediction == r.label for r in drawn.transform(df).collect()]) > 0.85


def test_tree_search_is_the_same_by_copies_and_by_passes(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors
    from corpusmill.operators import selection as L
    from corpusmill.operators import trees as D
    rng = np.random.default_rng(4)
    x = np.where(rng.random((150, 5)) < 0.5, np.round(rng.random((150, 5)) * 9 - 3), 0.0)
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 1).astype(int)
    data = [(i, int(y[i]), i % 2, Vectors.sparse(5, [(j, float(v)) for j, v in enumerate(r) if v])) for i, r in enumerate(x)]
    df = spark.createDataFrame(data, ["doc_id", "label", "fold", "features"]).repartition(3).persist()
    grid = {"maxDepth": [2, 3], "maxIter": [4], "leafPenalty": [0.0, 5.0], "minInfoGain": [1 / 75]}
    here = sorted(map(tuple, L.cv_grid_gbt(df, grid, k=2).drop("fit_seconds").collect()))
    monkeypatch.setattr(D, "_SCANNED", 8)       # features searched in several runs
    assert here == sorted(map(tuple, L.cv_grid_gbt(df, grid, k=2).drop("fit_seconds").collect())) and len(here) == 8
    monkeypatch.setattr(D, "_WHOLE", 0)
    assert here == sorted(map(tuple, L.cv_grid_gbt(df, grid, k=2).drop("fit_seconds").collect()))
    for penalty, depth, _, _, fold, train, test in here:
        if not penalty and depth == 3 and fold == 0:      # the model in Spark's form scores alike
            model = D.gbt(df.where(F.col("fold") != fold), 4, 3, 0.1, 1.0, 1.0)
            for side, score in ((F.col("fold") != fold, train), (F.col("fold") == fold, test)):
                assert math.isclose(score, model.transform(df.where(side)).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])


def test_a_leaf_penalty_shrinks_leaves_and_every_setting_is_searched(spark):
    from corpusmill.config import TREE_SPACE
    from corpusmill.operators import selection as L
    from corpusmill.operators import trees as D
    tree = D._Tree(1, 2.0)
    tree.split[1], tree.stats[2], tree.stats[3] = True, (4, 3, 3), (1, -1, 1)
    assert tree.values()[2:].tolist() == [0.5, -1 / 3]
    grid = L.tree_grid(TREE_SPACE, 10)
    assert math.prod(map(len, grid.values())) == 27 and grid["maxIter"] == [90]


def test_coverage_reads_the_rows_once_a_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def passes(coverage):
        before = seen.value
        R.fit_nystrom(rows(spark).mapInArrow(counted, "doc_id long, label int, idx array<int>, val array<double>"), 6, R.KernelSpec("rbf", 0.5), 8, passes=2, coverage=coverage)
        return (seen.value - before) / 40

    # With coverage there is one reading more, of what the last pass leaves.
    assert passes(R.Coverage([], [])) == passes(None) + 1
