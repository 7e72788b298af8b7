"""Metrics against published values and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import curves as U
from corpusmill.operators import metrics as M
from corpusmill.operators import selection as L
from corpusmill.operators.profile import imbalance_verdict


def conf(spark, tp, tn, fp, fn):
    return spark.createDataFrame([(tp, tn, fp, fn)], "tp long, tn long, fp long, fn long")


def frame(spark, rows):
    return spark.createDataFrame([(i, y, float(s), int(s >= 0.5)) for i, (y, s) in enumerate(rows)],
                                 "doc_id long, label int, score double, pred int")


def random_rows(n=400, seed=3):
    rng = random.Random(seed)
    return [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(n)]


@pytest.mark.parametrize("counts, want", [
    ((4220, 3550, 31, 19), (0.9936061381, 0.9927075982, 0.9955178108, 0.9913432002, 0.9941107185)),
    ((3437, 4982, 240, 1341), (0.8419, 0.9347293990, 0.7193386354, 0.9540405975, 0.8130100532)),
])
def test_published_binary_metrics(spark, counts, want):
    got = M.binary_metrics(conf(spark, *counts)).first()
    assert all(math.isclose(g, w, abs_tol=1e-9) for g, w in zip(
        (got.accuracy, got.precision, got.recall, got.specificity, got.f1_score), want))


@pytest.mark.parametrize("matrix, want", [
    (((3476, 105), (76, 4163)), (0.9768542199, 0.9768661066, 0.9706785814, 0.9768466206)),
    (((34324, 2782), (9473, 25555)), (0.8301078548, 0.8410642187, 0.9250256023, 0.8281633889)),
    (((36034, 1072), (9474, 25554)), (0.8537998725, 0.8733590093, 0.9711097936, 0.8512724560)),
])
def test_published_weighted_metrics(spark, matrix, want):
    (tn, fp), (fn, tp) = matrix
    got = M.weighted_metrics(conf(spark, tp, tn, fp, fn)).first()
    assert all(math.isclose(g, w, abs_tol=1e-9) for g, w in zip(
        (got.accuracy, got.precision_weighted, got.specificity, got.f1_weighted), want))


def test_published_report(spark):
    rows = {r.row: r for r in M.classification_report(conf(spark, 25554, 36034, 1072, 9474)).collect()}
    want = {"class_0": (.79, .97, .87, 37106), "class_1": (.96, .73, .83, 35028),
            "macro_avg": (.88, .85, .85, 72134), "weighted_avg": (.87, .85, .85, 72134)}
    for name, values in want.items():
        r = rows[name]
        assert (round(r.precision, 2), round(r.recall, 2), round(r.f1_score, 2), r.support) == values


def test_zero_denominators(spark):
    got = M.binary_metrics(conf(spark, 0, 0, 0, 0)).first()
    assert got.accuracy == got.precision == got.f1_score == 0.0


def test_auc_with_ties_by_pair_counting(spark):
    rows = random_rows()
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = frame(spark, rows)
    assert math.isclose(U.auc_roc(df).first().auc_roc, want)
    flipped = df.withColumn("score", -F.col("score"))
    assert math.isclose(U.auc_roc(flipped).first().auc_roc, 1 - want)
    # Other bucket borders, same area.
    assert math.isclose(U.auc_roc(df, splits=[float("-inf"), 0.9, float("inf")]).first().auc_roc, want)


def test_auc_of_a_single_class_and_of_equal_scores(spark):
    assert U.auc_roc(frame(spark, [(1, .2), (1, .9)])).first().auc_roc == 0.5
    assert U.auc_roc(frame(spark, [(1, .4), (0, .4)])).first().auc_roc == 0.5


def test_grouped_auc(spark):
    df = frame(spark, random_rows()).withColumn("g", (F.col("doc_id") % 3).cast("int"))
    whole = {r.g: r.auc_roc for r in U.auc_roc(df, "g").collect()}
    for g in range(3):
        assert math.isclose(whole[g], U.auc_roc(df.where(F.col("g") == g)).first().auc_roc)


def test_curves_share_a_written_table(spark):
    df = frame(spark, random_rows())
    table = U.ScoreTable.of(df)
    assert U.ScoreTable.of(table) is table
    plan = table.counts._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "Aggregate" not in plan
    for curve in (U.roc_curve, U.pr_curve, U.auc_roc, U.average_precision):
        assert sorted(map(str, curve(table).collect())) == sorted(map(str, curve(df).collect()))
    by_group = U.ScoreTable.of(df.withColumn("g", F.col("doc_id") % 3), "g")
    assert U.roc_curve(by_group).groupBy("g").count().count() == 3 == U.auc_roc(by_group).count()
    none = U.ScoreTable.of(df.where("false"))
    assert U.roc_curve(none).count() == 1 and U.pr_curve(none).count() == 0 and U.auc_roc(none).first().auc_roc == 0.5


def test_sweep_by_brute_force(spark):
    rows = random_rows() + [(1, 1.0), (0, 0.0), (1, 50 * (-1 / 99) + 1)]
    got = {r.step: r for r in U.threshold_sweep(frame(spark, rows)).collect()}
    n_pos, n_neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    for k in range(100):
        t = 0.0 if k == 99 else k * (-1 / 99) + 1
        tp = sum(y == 1 and s >= t for y, s in rows)
        fp = sum(y == 0 and s >= t for y, s in rows)
        assert math.isclose(got[k].tpr, tp / n_pos) and math.isclose(got[k].fpr, fp / n_neg)
        assert math.isclose(got[k].precision, tp / (tp + fp) if tp + fp else 1.0)


def test_running_metrics_by_brute_force(spark):
    rows = random_rows(137)
    got = {r.batch: r for r in U.running_metrics(frame(spark, rows), 10).collect()}
    assert len(got) == 14
    for batch, r in got.items():
        prefix = rows[:(batch + 1) * 10]
        assert r.tp == sum(y == 1 and s >= .5 for y, s in prefix)
        assert math.isclose(r.accuracy, sum(y == (s >= .5) for y, s in prefix) / len(prefix))


def test_running_metrics_cross_blocks(spark):
    counts = spark.range(9000).select(F.col("id").alias("batch"), F.lit(1).alias("tp"), F.lit(0).alias("tn"),
                                      F.lit(0).alias("fp"), F.lit(0).alias("fn"))
    got = U.accumulate_batches(counts).where("batch in (0, 4095, 4096, 8999)").collect()
    assert {r.batch: r.tp for r in got} == {0: 1, 4095: 4096, 4096: 4097, 8999: 9000}


def test_verdicts(spark):
    def verdict(n0, n1):
        df = spark.range(n0 + n1).select((F.col("id") >= n0).cast("int").alias("label"))
        return imbalance_verdict(df).first().verdict
    assert verdict(5, 5) == "Perfectly Balanced"
    assert verdict(14320, 16956) == "Roughly Balanced"
    assert verdict(1, 9) == "Imbalanced"


def test_gap_verdict(spark):
    df = spark.createDataFrame([("train", 90, 90, 10, 10), ("test", 80, 80, 20, 20)], "split string, tp long, tn long, fp long, fn long")
    got = M.train_test_gap(M.binary_metrics(df)).first()
    assert math.isclose(got.avg_gap, 10.0) and got.verdict == "Some Overfitting"


def test_leaderboard_first_wins_ties(spark):
    runs = spark.createDataFrame(
        [(0, "a", .9, .8, .7, 5.0), (1, "b", .9, .9, .7, 5.0), (2, "c", .1, .1, .9, 9.0)],
        "run_no int, config_name string, accuracy double, f1_score double, auc_score double, training_time double")
    got = {r.criterion: r.config_name for r in L.leaderboard(runs).collect()}
    assert got == {"best_accuracy": "a", "best_f1": "b", "best_auc": "c", "fastest_training": "a"}
