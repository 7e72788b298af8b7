"""Model selection: grids, cross-validation tables, curves, leaderboards.

Result tables have one row per configuration and fold. They are as small as
the grid the caller asked for.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusmill.operators.curves import auc_roc
from corpusmill.operators.linear import DescentRun, descend
from corpusmill.operators.metrics import binary_metrics, confusion_counts, weighted_metrics
from corpusmill.operators.naive_bayes import KINDS, absent_weight, class_prior, class_sizes, cv_scores, label_term_sums, term_weight, with_prediction
from corpusmill.operators.tfidf import sparse_rows
from corpusmill.operators.trees import tree_hits
from corpusmill.session import materialize

CV_METRICS = ("accuracy", "precision", "sensitivity", "specificity", "f1", "auc")


class SpecificityEvaluator(Evaluator):
    """Class-0 recall as a metric for Spark ML tuning."""

    def _evaluate(self, dataset: DataFrame) -> float:
        conf = confusion_counts(dataset, pred="prediction")
        return float(weighted_metrics(conf).first()["specificity"])

    def isLargerBetter(self) -> bool:
        return True


def evaluate_splits(scored: DataFrame) -> DataFrame:
    """The metric set for each side of the split."""
    conf = binary_metrics(confusion_counts(scored, "split"))
    return conf.join(F.broadcast(auc_roc(scored, "split")), "split")  # one row per side


def cv_grid(docs: DataFrame, weights: DataFrame, alphas: list[float], kinds=KINDS, k: int = 5,
            max_features: int = 20000) -> DataFrame:
    """(kind, alpha, fold, metric, value) for all six metrics of all models."""
    scored = materialize(with_prediction(cv_scores(docs, weights, alphas, kinds, k, max_features)), "cv_scores")
    keys = ("kind", "alpha", "fold")
    # Ordering by the margin avoids the ties that a saturated sigmoid makes.
    margins = scored.withColumn("score", F.col("margin"))
    table = weighted_metrics(confusion_counts(scored, *keys)).join(auc_roc(margins, *keys), list(keys))
    named = {"accuracy": "accuracy", "precision": "precision_weighted", "sensitivity": "recall_weighted",
             "specificity": "specificity", "f1": "f1_weighted", "auc": "auc_roc"}
    return table.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in named.items()])))


def cv_means(table: DataFrame) -> DataFrame:
    return table.groupBy("kind", "alpha", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def best_of_family(table: DataFrame, metric: str = "accuracy") -> DataFrame:
    """Best alpha per kind (first on ties) and the rank of the kinds."""
    means = cv_means(table).where(F.col("metric") == metric)
    # Rounded so that equal fold scores stay equal whatever the order of addition.
    tidy = means.withColumn("mean", F.round("mean", 12))
    first = Window.partitionBy("kind").orderBy(F.desc("mean"), "alpha")
    best = tidy.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r", "metric", "std")
    return best.withColumn("family_rank", F.row_number().over(Window.orderBy(F.desc("mean"), "kind")))


def metric_vs_alpha(table: DataFrame) -> DataFrame:
    """One row per kind and alpha, one column per metric."""
    return table.groupBy("kind", "alpha").pivot("metric", list(CV_METRICS)).agg(F.avg("value"))


def cv_summary(table: DataFrame, metric: str = "accuracy") -> DataFrame:
    """Mean and deviation of the best configuration's fold scores."""
    best = best_of_family(table, metric).where("family_rank = 1").select("kind", "alpha")
    return (table.where(F.col("metric") == metric).join(F.broadcast(best), ["kind", "alpha"])  # one row
            .groupBy("kind", "alpha").agg(F.avg("value").alias("mean_score"), F.stddev_pop("value").alias("std_score"),
                                          F.count("*").alias("n_folds")))


def param_effect(results: DataFrame, param: str, score: str = "score") -> DataFrame:
    return results.groupBy(param).agg(F.avg(score).alias("mean_score"), F.stddev_samp(score).alias("std_score"))


def param_pivot(results: DataFrame, rows: str, columns: str, values: list, score: str = "score") -> DataFrame:
    """Mean score of every pair of values, averaged over the other parameters."""
    return results.groupBy(rows).pivot(columns, values).agg(F.avg(score))


def top_configs(results: DataFrame, n: int = 10, score: str = "score", *ties: str) -> DataFrame:
    return results.orderBy(F.desc(score), *ties).limit(n)


def leaderboard(results: DataFrame) -> DataFrame:
    """Winner per criterion; of equal results the first run wins.

    ``results``: run_no, config_name, accuracy, f1_score, auc_score, training_time.
    """
    def pick(name, value, largest):
        key = F.struct(F.col(value) if largest else -F.col(value), -F.col("run_no"))
        return F.struct(F.lit(name).alias("criterion"), F.max_by("config_name", key).alias("config_name"),
                        (F.max if largest else F.min)(value).alias("value"))
    rows = [pick("best_accuracy", "accuracy", True), pick("best_f1", "f1_score", True),
            pick("best_auc", "auc_score", True), pick("fastest_training", "training_time", False)]
    return results.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def grid_search_holdout(train_rows: DataFrame, valid_rows: DataFrame, size: int, space: dict, tolerance: float = 0.0,
                        state: str | None = None) -> DataFrame:
    """Every configuration of ``space`` on one validation side, in the order of the grid.

    All runs descend together: one scan of ``train_rows`` updates a matrix of
    weights, and iteration counts are snapshots of their run. All models then
    score ``valid_rows`` in one scan as well. Rows: run_no, the settings, steps
    (fewer than n_iterations where the run stopped by ``tolerance``), norm,
    n_valid, accuracy, f1_score.
    """
    spark = train_rows.sparkSession
    counts = sorted(space["n_iterations"])
    pairs = list(product(space["learning_rate"], space["regularization"]))
    _, kept = descend(train_rows, size, [DescentRun(lr, reg) for lr, reg in pairs], counts[-1], tuple(counts), tolerance, state)
    grid = [(lr, n, reg) for lr, n, reg in product(space["learning_rate"], space["n_iterations"], space["regularization"])]
    models = [kept[pairs.index((lr, reg)), n] for lr, n, reg in grid]
    settings = spark.createDataFrame(
        [(i, float(lr), int(n), float(reg), m.steps, float(m.norm)) for i, ((lr, n, reg), m) in enumerate(zip(grid, models))],
        "run_no int, learning_rate double, n_iterations int, regularization double, steps int, norm double")
    confusion = confusion_counts(score_all(valid_rows, models), "run_no")
    scores = binary_metrics(confusion).select("run_no", (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).cast("long").alias("n_valid"), "accuracy", "f1_score")
    return settings.join(F.broadcast(scores), "run_no", "left")     # a row per configuration


def score_all(rows: DataFrame, models: list) -> DataFrame:
    """(run_no, label, pred) of every row under every model, from one scan; the models travel as one matrix."""
    weights, bias = np.stack([m.weights for m in models]), np.array([m.bias for m in models])
    shared = rows.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            idx, val = batch.column("idx"), batch.column("val")
            cols, x = idx.flatten().to_numpy(), val.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(idx.offsets.to_numpy()))
            for r in range(len(bias)):
                z = np.bincount(row, weights=x * weights[r][cols], minlength=batch.num_rows) + bias[r]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(z), r, np.int32)), batch.column("label"), pa.array((z >= 0).astype(np.int32))], ["run_no", "label", "pred"])

    return rows.select("label", "idx", "val").mapInArrow(run, "run_no int, label int, pred int")


def best_configuration(results: DataFrame, score: str = "accuracy") -> DataFrame:
    """The winner: the first row, in the order of the grid, that no other exceeds."""
    return results.orderBy(F.desc(F.round(score, 12)), "run_no").limit(1)


@dataclass
class Tuned:
    """Result of a cross-validated search: one row per setting and fold, and the number of the best setting."""

    table: DataFrame
    best: int


def _timed(estimator):
    """The same estimator, whose models carry the seconds of their fit."""
    def fit(self, dataset):
        start = time.perf_counter()
        model = super(kind, self)._fit(dataset)
        model.fit_seconds = time.perf_counter() - start
        return model

    kind = type(f"Timed{type(estimator).__name__}", (type(estimator),), {"_fit": fit})
    timed = estimator.copy()
    timed.__class__ = kind
    return timed


def cross_validated(vectors: DataFrame, estimator, grid: dict, evaluator: Evaluator, k: int = 5, parallelism: int = 4) -> Tuned:
    """Every setting of ``grid`` on every fold, ``parallelism`` fits at a time.

    ``vectors`` has label, features and ``fold`` (0 to k - 1) and should be
    persisted. The fitted model of every fold is kept until it has been scored
    on both sides. Rows: setting, the parameters, fold, train_score, test_score,
    fit_seconds (of that fit, beside those running with it). The best setting is the tuner's own: the first with the best mean.
    """
    spark = vectors.sparkSession
    names = sorted(grid)
    settings = list(product(*[grid[n] for n in names]))
    maps = [{getattr(estimator, n): v for n, v in zip(names, values)} for values in settings]
    folded = vectors.withColumn("fold", F.col("fold").cast("int"))
    tuner = CrossValidator(estimator=_timed(estimator), estimatorParamMaps=maps, evaluator=evaluator, numFolds=k, foldCol="fold",
                           parallelism=parallelism, collectSubModels=True)
    model = tuner.fit(folded)

    def scores(cell):
        fold, setting = cell
        fitted = model.subModels[fold][setting]
        scored = fitted.transform(folded)
        train, test = (evaluator.evaluate(scored.where(side)) for side in (F.col("fold") != fold, F.col("fold") == fold))
        return (setting, *[float(v) for v in settings[setting]], fold, float(train), float(test), fitted.fit_seconds)

    with ThreadPool(parallelism) as pool:
        rows = pool.map(scores, list(product(range(k), range(len(settings)))))
    pick = np.argmax if evaluator.isLargerBetter() else np.argmin
    columns = ", ".join(f"{n} double" for n in names)
    return Tuned(spark.createDataFrame(rows, f"setting int, {columns}, fold int, train_score double, test_score double, fit_seconds double"), int(pick(model.avgMetrics)))


def search_summary(tuned: Tuned) -> DataFrame:
    """One row for the best setting: mean and deviation of its fold scores, mean seconds of a fit."""
    return tuned.table.where(F.col("setting") == tuned.best).groupBy("setting").agg(
        F.avg("test_score").alias("mean_score"), F.stddev_pop("test_score").alias("std_score"),
        F.avg("fit_seconds").alias("mean_fit_time"), F.count("*").alias("n_folds"))


def tree_grid(space: dict, n_rows: int) -> dict:
    """A tree search space in Spark's names. ``gamma`` is a gain of all rows there, a gain per row here; ``leafPenalty`` is added to the rows of a leaf."""
    return {"maxIter": space["n_estimators"], "maxDepth": space["max_depth"], "stepSize": space["learning_rate"],
            "subsamplingRate": space["subsample"], "minInfoGain": [g / max(n_rows, 1) for g in space["gamma"]], "leafPenalty": space["reg_lambda"]}


TREE_DEFAULTS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 1.0, "minInfoGain": 0.0, "leafPenalty": 0.0}


def cv_grid_gbt(vectors: DataFrame, grid: dict, k: int = 5, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Fold accuracies (train and test) and fit seconds of every tree setting; the rows are binned once a fold.

    ``vectors`` has label, features and ``fold`` (0 to k - 1). What ``grid`` does not name is as in Spark's estimator.
    """
    names = sorted(grid)
    settings = list(product(*[grid[n] for n in names]))
    full = [TREE_DEFAULTS | dict(zip(names, values)) for values in settings]
    fits = [(int(f["maxIter"]), int(f["maxDepth"]), f["stepSize"], f["subsamplingRate"], f["minInfoGain"], seed, f["leafPenalty"]) for f in full]
    rows = []
    for fold in range(k):
        hits = tree_hits(vectors.withColumn("held", F.col("fold") == fold), fits, parallelism)
        rows += [(*[float(v) for v in values], fold, t / n if n else None, h / m if m else None, took) for values, (t, n, h, m, took) in zip(settings, hits)]
    return vectors.sparkSession.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", fold int, train_score double, test_score double, fit_seconds double")


def _samples(k: int, parts: int, fold: Column, part: Column) -> Column:
    """The samples (held, size) that rows of a fold and a part belong to: other folds held out, sizes from the part on."""
    return F.array(*[F.struct(F.lit(f).alias("held"), F.lit(i).alias("size"), ((fold != f) & (part <= i)).alias("inside"))
                     for f, i in product(range(k), range(1, parts + 1))])


MEASURES = ("f0", "f1", "d0", "d1")


def _sample_sums(k: int, parts: int):
    """Sums of every term over every sample, from its sums by fold and part."""
    def run(batches):
        others = 1.0 - np.eye(k)
        for batch in batches:
            column = batch.column("_c")
            term = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
            cell = column.flatten()
            fold, part = (cell.field(c).to_numpy(zero_copy_only=False).astype(int) for c in ("fold", "part"))
            out = []
            for name in MEASURES:
                dense = np.zeros((batch.num_rows, k, parts))
                dense[term, fold, part - 1] = cell.field(name).to_numpy(zero_copy_only=False)
                # Added up fold by fold, not taken from a total: zeros stay exact zeros.
                held = np.einsum("hf,tfp->thp", others, np.cumsum(dense, axis=2)).ravel()
                out.append(pa.array(held if name[0] == "f" else np.rint(held).astype(np.int64)))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("term_idx").to_numpy(), k * parts)), pa.array(np.tile(np.repeat(np.arange(k, dtype=np.int32), parts), n)),
                pa.array(np.tile(np.arange(1, parts + 1, dtype=np.int32), n * k)), *out], ["term_idx", "held", "size", *MEASURES])
    return run


def learning_curve_nb(docs: DataFrame, weights: DataFrame, vocab: DataFrame, kind: str, alpha: float,
                      parts: int = 10, k: int = 5, max_features: int = 20000) -> DataFrame:
    """Train and cross-validation accuracy against the training size.

    ``docs`` and ``weights`` carry ``fold`` and ``part``; the sample of size i
    is part <= i of the other folds. Postings are summed once by (term, fold,
    part); the samples are sums over that small table. All k * parts models
    score a document in one scan, as one matrix that the vocabulary cap bounds.
    """
    grid = list(product(range(k), range(1, parts + 1)))
    cells = label_term_sums(weights, "fold", "part")
    # At most folds x parts cells a term. A term absent from a sample keeps a row of zeros there.
    per_term = cells.groupBy("term_idx").agg(F.collect_list(F.struct("fold", "part", *MEASURES)).alias("_c"))
    sums = materialize(per_term.mapInArrow(_sample_sums(k, parts), "term_idx int, held int, size int, f0 double, f1 double, d0 long, d1 long"), "curve-sums")
    n = (class_sizes(docs, "fold", "part").withColumn("_s", F.explode(_samples(k, parts, F.col("fold"), F.col("part"))))
         .groupBy("_s.held", "_s.size").agg(*[F.sum(F.when(F.col("_s.inside"), F.col(c)).otherwise(0)).alias(c) for c in ("n0", "n1")]))
    totals = sums.groupBy("held", "size").agg(F.sum("f0").alias("t0"), F.sum("f1").alias("t1"), F.count("*").alias("v"))
    full = sums.join(F.broadcast(n.join(totals, ["held", "size"])), ["held", "size"])     # k * parts rows
    absent = F.sum(absent_weight(alpha)) if kind == "BNB" else F.lit(0.0)
    bias = full.groupBy("held", "size").agg(absent.alias("_a"), F.first("n0").alias("n0"), F.first("n1").alias("n1"))
    shift = {(r.held, r.size_): r.b for r in bias.select("held", F.col("size").alias("size_"), (F.col("_a") + class_prior(kind)).alias("b")).collect()}
    models = full.select("term_idx", F.struct("held", "size", term_weight(kind, alpha).alias("w")).alias("_w")).groupBy("term_idx").agg(
        F.sort_array(F.collect_list("_w")).alias("_w")).select("term_idx", F.col("_w.w").alias("w"))
    table = models.collect()                                                            # the vocabulary cap bounds it
    width = max((r.term_idx for r in table), default=-1) + 1
    matrix = np.zeros((width, len(grid)))
    for r in table:
        matrix[r.term_idx] = [0.0 if w is None else w for w in r.w]
    bias_row = np.array([np.nan if shift.get(cell) is None else shift[cell] for cell in grid])
    rows = sparse_rows(docs, weights, "label", "fold", "part")
    hits = rows.mapInArrow(_curve_hits(rows.sparkSession.sparkContext.broadcast((matrix, bias_row)), grid, kind == "BNB"),
                           "held int, size int, train_hits long, train_n long, test_hits long, test_n long")
    shares = hits.groupBy("held", "size").agg(F.try_divide(F.sum("train_hits"), F.sum("train_n")).alias("train"),
                                              F.try_divide(F.sum("test_hits"), F.sum("test_n")).alias("test"))
    return shares.groupBy("size").agg(
        F.avg("train").alias("train_mean"), F.stddev_pop("train").alias("train_std"),
        F.avg("test").alias("cv_mean"), F.stddev_pop("test").alias("cv_std"))


CURVE_VALUES = 16_384     # values of sparse rows multiplied at once


def _curve_hits(shared, grid, presence):
    """Hits and rows of every sample, and of its held-out fold, added up per batch."""
    def run(batches):
        matrix, bias = shared.value
        held, size = np.array(grid).T
        for batch in batches:
            idx, val = batch.column("idx"), batch.column("val")
            label, fold, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold", "part"))
            cols, x = idx.flatten().to_numpy(), val.flatten().to_numpy()
            x = np.ones_like(x) if presence else x
            lengths = np.diff(idx.offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(lengths)])
            z = np.zeros((batch.num_rows, len(grid)))
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + CURVE_VALUES, side="right")) - 1)
                piece = slice(ends[start], ends[stop])
                product_ = np.append(x[piece, None] * matrix[cols[piece]], np.zeros((1, len(grid))), axis=0)
                z[start:stop] = np.add.reduceat(product_, ends[start:stop] - ends[start], axis=0) * (lengths[start:stop, None] > 0)
                start = stop
            hit = ~(z + bias <= 0) == (label[:, None] == 1)     # an undefined score counts as positive
            train = (fold[:, None] != held) & (part[:, None] <= size)
            test = fold[:, None] == held
            counts = [(hit & train).sum(axis=0), train.sum(axis=0), (hit & test).sum(axis=0), test.sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(size.astype(np.int32)), *[pa.array(c.astype(np.int64)) for c in counts]],
                                             ["held", "size", "train_hits", "train_n", "test_hits", "test_n"])
    return run


def multi_config_compare(configs: list[dict], fit, score_internal, score_external, spark, parallelism: int = 1) -> DataFrame:
    """Train and time every named configuration, then score both corpora; ``parallelism`` configurations at a time.

    ``fit(config)`` returns a model; the scorers return label/pred/score frames.
    One row per configuration, in the order given. Times include the waiting
    for executors that fits running beside one another cause.
    """
    def run(numbered):
        number, config = numbered
        start = time.perf_counter()
        model = fit(config)
        took = time.perf_counter() - start
        inner = weighted_metrics(confusion_counts(score_internal(model))).first()
        outer_frame = materialize(score_external(model).select("label", "pred", "score"), "compared")
        outer = weighted_metrics(confusion_counts(outer_frame)).first()
        auc = auc_roc(outer_frame).first().auc_roc
        return (number, config["name"], inner.tp + inner.tn + inner.fp + inner.fn, inner.accuracy,
                outer.tp + outer.tn + outer.fp + outer.fn, outer.accuracy, outer.precision_weighted,
                outer.recall_weighted, outer.specificity, outer.f1_weighted, auc, took)

    with ThreadPool(parallelism) as pool:
        rows = pool.map(run, list(enumerate(configs)), chunksize=1)
    return spark.createDataFrame(rows, "run_no int, config_name string, n_internal long, internal_acc double, n_external long, external_acc double, "
                                       "precision double, recall double, specificity double, f1_score double, "
                                       "auc_score double, training_time double")
