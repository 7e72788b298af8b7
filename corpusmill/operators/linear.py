"""Linear models: gradient descent, logistic regression, linear SVM."""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.classification import LogisticRegression as MLLogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions.numeric import log_loss_term, sigmoid
from corpusmill.operators.naive_bayes import LinearScorer, class_sizes
from corpusmill.session import broadcast_bounded

_BLOCK_VALUES = 1 << 18   # values of sparse rows in one block
_WHOLE = 192 << 20        # bytes of packed blocks that a task may hold at once
_DIRECT = 16              # partitions whose sums go to the driver as they are; those of more are added up by Spark first


@dataclass
class DescentModel:
    """Weights of one run; the vector is as long as the vocabulary."""

    weights: np.ndarray
    bias: float
    costs: list[tuple[int, float]] = field(default_factory=list)
    steps: int = 0                  # updates made
    norm: float = float("nan")      # of the gradient before the last update, or at the weights where the run stopped
    first_norm: float = float("nan")

    def weight_frame(self, spark) -> DataFrame:
        rows = [(i, float(w)) for i, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, "term_idx int, w double")

    def scorer(self, spark) -> LinearScorer:
        return LinearScorer(self.weight_frame(spark), float(self.bias))

    def cost_history(self, spark) -> DataFrame:
        return spark.createDataFrame(self.costs, "iteration int, cost double")


@dataclass(frozen=True)
class DescentRun:
    """Settings of one descent."""

    learning_rate: float = 0.05
    regularization: float = 0.001


def _pack_task(batches):
    """Sparse rows as pickled blocks of arrays, by rows and by features, so that a pass only multiplies and adds up."""
    for batch in batches:
        idx, val = batch.column("idx"), batch.column("val")
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        cols, x, ends = idx.flatten().to_numpy(), val.flatten().to_numpy(), idx.offsets.to_numpy() - idx.offsets[0].as_py()
        start = 0
        while start < len(label):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + _BLOCK_VALUES, side="right")) - 1)
            part, lengths = slice(ends[start], ends[stop]), np.diff(ends[start:stop + 1])
            order = np.argsort(cols[part], kind="stable")
            by_col = cols[part][order]
            first = np.flatnonzero(np.diff(by_col, prepend=-1))
            filled = np.flatnonzero(lengths)
            block = (label[start:stop], cols[part], x[part], filled, (ends[start:stop] - ends[start])[filled],
                     np.repeat(np.arange(stop - start, dtype=np.int32), lengths)[order], x[part][order], by_col[first], first)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, pickle.HIGHEST_PROTOCOL)], pa.binary())], ["block"])
            start = stop


def _packed(rows: DataFrame):
    """The rows as blocks, read once and kept by the executors; as many partitions as cores, whose sums a pass adds up."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    few = rows.select("label", "idx", "val").coalesce(max(1, min(rows.rdd.getNumPartitions(), cores)))
    return few.mapInArrow(_pack_task, "block binary").rdd.map(lambda r: bytes(r.block)).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(blocks, weights, bias):
    """Gradient sums of unpacked blocks for every run, and the other sums."""
    runs, size = weights.shape
    total, rest = np.zeros((runs, size)), np.zeros((3, runs))
    for y, cols, x, filled, starts, row, x_by_feature, features, first in blocks:
        held = np.empty(len(x))
        for r in range(runs):
            z = np.full(len(y), bias[r])
            if len(x):
                # Narrow indices are not widened first, as they are where ``take`` checks them and makes its result.
                np.multiply(x, weights[r].take(cols, out=held, mode="clip"), out=held)
                z[filled] += np.add.reduceat(held, starts)
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
            diff = p - y
            if len(x):
                np.multiply(x_by_feature, diff.take(row, out=held, mode="clip"), out=held)
                total[r, features] += np.add.reduceat(held, first)
            q = np.clip(p, 1e-15, 1 - 1e-15)
            rest[0, r] += diff.sum()
            rest[1, r] -= (y * np.log(q) + (1 - y) * np.log(1 - q)).sum()
            rest[2, r] += len(y)
    return total, rest


def _gradient_task(shared):
    """The sums of a partition."""
    def run(blocks):
        weights, bias = shared.value
        yield _sums(map(pickle.loads, blocks), weights, bias)
    return run


def _added(a, b):
    return a[0] + b[0], a[1] + b[1]


def _full_pass(blocks, weights: np.ndarray, bias: np.ndarray):
    """Gradient, bias gradient and loss sums of all runs over all rows, and the rows.

    What the driver gets is sized by the features and runs: beyond a few
    partitions the sums are added up by Spark first.
    """
    shared = blocks.context.broadcast((weights, bias))
    sums = blocks.mapPartitions(_gradient_task(shared))
    grad, rest = sums.treeReduce(_added) if blocks.getNumPartitions() > _DIRECT else reduce(_added, sums.collect())
    shared.destroy()
    return grad, rest[0], rest[1], int(rest[2, 0])


class _Runs:
    """Where the runs of a descent stand."""

    def __init__(self, runs: list[DescentRun], size: int):
        count = len(runs)
        self.rate, self.penalty = (np.array([getattr(r, n) for r in runs]) for n in ("learning_rate", "regularization"))
        self.weights, self.bias, self.steps, self.done = np.zeros((count, size)), np.zeros(count), np.zeros(count, int), np.zeros(count, bool)
        self.norm, self.start = np.full(count, np.nan), np.full(count, np.nan)
        self.costs, self.kept = [[] for _ in runs], {}

    _BY_RUN = ("rate", "penalty", "weights", "bias", "steps", "done", "norm", "start")

    def part(self, chosen) -> _Runs:
        """Some of the runs, without the snapshots."""
        out = object.__new__(_Runs)
        for name in self._BY_RUN:
            setattr(out, name, getattr(self, name)[chosen].copy())
        out.costs, out.kept = [list(self.costs[r]) for r in chosen], {}
        return out

    def put(self, chosen, part: _Runs) -> None:
        """What ``part`` of these runs has become."""
        for name in self._BY_RUN:
            getattr(self, name)[chosen] = getattr(part, name)
        for k, r in enumerate(chosen):
            self.costs[r] = part.costs[k]
        self.kept.update({(int(chosen[k]), n): m for (k, n), m in part.kept.items()})

    def model(self, r: int) -> DescentModel:
        return DescentModel(self.weights[r].copy(), float(self.bias[r]), list(self.costs[r]), int(self.steps[r]), float(self.norm[r]), float(self.start[r]))

    def advance(self, first: int, stop: int, full_pass, n_iterations: int, snapshots, tolerance: float) -> bool:
        """Passes ``first`` to ``stop`` - 1 of ``n_iterations`` and one that moves nothing; false if the descent ended before."""
        for i in range(first, stop):
            live = np.flatnonzero(~self.done)
            note = i and (i - 1) % 100 == 0
            if not len(live) or i == n_iterations and not (note or tolerance):
                return False
            grad, d_bias, loss, n = full_pass(self.weights[live], self.bias[live])
            if not n:
                return False
            if note:
                for k, r in enumerate(live):
                    self.costs[r].append((i - 1, float(loss[k] / n + self.penalty[r] / (2 * n) * (self.weights[r] @ self.weights[r]))))
            step = grad / n + (self.penalty[live] / n)[:, None] * self.weights[live]
            self.norm[live] = np.sqrt((step ** 2).sum(axis=1) + (d_bias / n) ** 2)
            if i == 0:
                self.start[:] = self.norm
            self.done[live] = self.norm[live] <= tolerance * self.start[live]
            if i == n_iterations:
                return False
            moving = ~self.done[live]
            self.weights[live[moving]] -= self.rate[live[moving], None] * step[moving]
            self.bias[live[moving]] -= self.rate[live[moving]] * d_bias[moving] / n
            self.steps[live[moving]] += 1
            if i + 1 in snapshots:
                self.kept.update({(r, i + 1): self.model(r) for r in range(len(self.bias))})
        return True


def _advance_task(shared):
    """All blocks in one task, which moves its share of the runs on without meeting the others."""
    def run(part, blocks):
        shares, first, stop, rest = shared.value
        chosen, mine = shares[part]
        unpacked = [pickle.loads(b) for b in blocks]

        def full_pass(weights, bias):
            grad, sums = _sums(unpacked, weights, bias)
            return grad, sums[0], sums[1], int(sums[2, 0])

        on = mine.advance(first, stop, full_pass, *rest)
        yield chosen, mine, on
    return run


def _advanced(blocks, state: _Runs, first: int, stop: int, *rest) -> bool:
    """``advance`` by tasks that hold all blocks: one job for all these passes, the runs dealt over the cores."""
    live = np.flatnonzero(~state.done)
    tasks = min(len(live), blocks.context.defaultParallelism)
    if not tasks:
        return False
    shares = [(live[t::tasks], state.part(live[t::tasks])) for t in range(tasks)]
    shared = blocks.context.broadcast((shares, first, stop, rest))
    copies = blocks.context.union([blocks.coalesce(1)] * tasks)
    going = False
    for chosen, mine, on in copies.mapPartitionsWithIndex(_advance_task(shared)).collect():
        state.put(chosen, mine)
        going |= on
    shared.destroy()
    return going


class DescentState:
    """Weights of a descent in the shared folder, so that a new driver goes on where the last one stopped.

    Every save is a folder of its own, complete only with Spark's success
    mark; a save that was broken off is passed over.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, step: int, weights, bias, steps, norm, start, kept, costs) -> None:
        rows = [(r, "weights", int(steps[r]), 0, float(bias[r]), weights[r].tolist(), float(norm[r]), float(start[r])) for r in range(len(bias))]
        rows += [(r, "snapshot", m.steps, n, float(m.bias), m.weights.tolist(), float(m.norm), 0.0) for (r, n), m in kept.items()]
        rows += [(r, "cost", i, 0, float(c), [], 0.0, 0.0) for r, history in enumerate(costs) for i, c in history]
        frame = self.spark.createDataFrame(rows, "run int, kind string, step int, at int, bias double, weights array<double>, norm double, start double")
        frame.write.mode("overwrite").parquet(f"{self.path}/step-{step:08d}")

    def last(self):
        """(step, rows) of the newest complete save, or None."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return None
        saves = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("step-")]
        path_type = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        whole = sorted(p.getName() for p in saves if files.exists(path_type(p, "_SUCCESS")))
        return (int(whole[-1][5:]), self.spark.read.parquet(f"{self.path}/{whole[-1]}").collect()) if whole else None


def descend(rows: DataFrame, size: int, runs: list[DescentRun], n_iterations: int = 1500, snapshots: tuple[int, ...] = (),
            tolerance: float = 0.0, state: str | None = None, every: int = 100) -> tuple[list[DescentModel], dict[tuple[int, int], DescentModel]]:
    """Full-batch descents of several settings from zero weights; one scan of ``rows`` updates all of them.

    A run stops once the norm of its gradient is at most ``tolerance`` times
    that of its first gradient; its later snapshots are the weights it stopped with. The cost is noted after
    every 100th update. With ``state`` the weights are written to that shared
    folder every ``every`` updates, and a call that finds a save goes on from it.
    Returns the final model of each run and those after the ``snapshots``
    iteration counts by (run, count). ``rows`` (doc_id, label, idx, val) are
    read once and kept as packed blocks; without rows all models are zero.
    Blocks of at most ``_WHOLE`` bytes in all go to every task, which makes
    ``every`` passes for its share of the runs; beyond, a pass is a job whose
    tasks add up the sums of their blocks.
    """
    blocks, now, first = _packed(rows), _Runs(runs, size), 0
    store = DescentState(rows.sparkSession, state) if state else None
    found = store.last() if store else None
    if found:
        first, saved = found
        for r in saved:
            if r.kind == "weights":
                now.weights[r.run], now.bias[r.run], now.steps[r.run], now.norm[r.run], now.start[r.run] = r.weights, r.bias, r.step, r.norm, r.start
            elif r.kind == "cost":
                now.costs[r.run].append((r.step, r.bias))
        now.costs = [sorted(c) for c in now.costs]
        now.kept = {(r.run, r.at): DescentModel(np.array(r.weights), r.bias, [c for c in now.costs[r.run] if c[0] < r.at - 1], r.step, r.norm, float(now.start[r.run])) for r in saved if r.kind == "snapshot"}
        now.done[:] = now.norm <= tolerance * now.start
    rest = (n_iterations, tuple(snapshots), tolerance)
    whole = blocks.map(len).sum() <= _WHOLE
    while first <= n_iterations:
        stop = min(first - first % every + every, n_iterations + 1)
        if whole:
            on = _advanced(blocks, now, first, stop, *rest)
        else:
            on = now.advance(first, stop, lambda weights, bias: _full_pass(blocks, weights, bias), *rest)
        if not on:
            break
        if store and stop % every == 0:
            store.save(stop, now.weights, now.bias, now.steps, now.norm, now.start, now.kept, now.costs)
        first = stop
    blocks.unpersist()
    final = [now.model(r) for r in range(len(runs))]
    kept = now.kept
    for r in range(len(runs)):
        for n in snapshots:
            kept.setdefault((r, n), final[r])
    return final, kept


def logreg_gd(rows: DataFrame, size: int, learning_rate: float = 0.05, n_iterations: int = 1500,
              regularization: float = 0.001, snapshots: tuple[int, ...] = (), tolerance: float = 0.0, state: str | None = None):
    """``descend`` of one setting; with ``snapshots`` the models after those iteration counts as well."""
    final, kept = descend(rows, size, [DescentRun(learning_rate, regularization)], n_iterations, snapshots, tolerance, state)
    return (final[0], {n: m for (_, n), m in kept.items()}) if snapshots else final[0]


def log_loss(scored: DataFrame, weights: DataFrame, regularization: float = 0.0) -> DataFrame:
    """Mean cross-entropy plus the penalty; the bias is not penalised."""
    penalty = weights.agg(F.sum(F.col("w") * F.col("w"))).scalar()
    m = F.count("*")
    return scored.agg((F.avg(log_loss_term(F.col("label"), F.col("score")))).alias("_l"), m.alias("_m")).select(
        (F.col("_l") + F.lit(regularization) / (2 * F.col("_m")) * penalty).alias("cost"))


def linear_score(docs: DataFrame, weights: DataFrame, params: DataFrame, bias: float | Column,
                 max_features: int, *keep: str) -> DataFrame:
    """X.w + b with its probability; unknown terms add nothing."""
    dots = (weights.join(broadcast_bounded(params, max_features, 32), "term_idx")
            .groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("w")).alias("_dot")))
    margin = F.coalesce("_dot", F.lit(0.0)) + bias
    return docs.select("doc_id", *keep).join(dots, "doc_id", "left").select(
        "doc_id", *keep, margin.alias("margin"), sigmoid(margin).alias("score"))


def logreg(vectors: DataFrame, n_rows: int, regularization: float = 0.001, max_iter: int = 100):
    """The same objective at its optimum, by Spark ML."""
    return MLLogisticRegression(regParam=regularization / n_rows, elasticNetParam=0.0,
                                standardization=False, maxIter=max_iter).fit(vectors)


def balanced_weights(docs: DataFrame) -> DataFrame:
    """(label, class_weight): n / (2 * n_c), one row per class."""
    one = class_sizes(docs).withColumn("_n", F.col("n0") + F.col("n1"))
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("label"),
                 F.try_divide(F.col("_n").cast("double"), 2.0 * F.col(f"n{c}")).alias("class_weight"))
        for c in (0, 1)])))


def svm_linear(vectors: DataFrame, n_rows: int, c: float = 1.0, balanced: bool = False,
               max_iter: int = 50) -> LinearSVCModel:
    kwargs = {}
    if balanced:
        vectors = vectors.join(F.broadcast(balanced_weights(vectors)), "label")
        kwargs["weightCol"] = "class_weight"
    return LinearSVC(regParam=1.0 / (c * n_rows), standardization=False, maxIter=max_iter, **kwargs).fit(vectors)


def hinge_objective(model: LinearSVCModel, vectors: DataFrame, balanced: bool = False) -> float:
    """What the SVM minimises, over the rows it was fitted on: weighted mean hinge loss and penalty.

    Zero weights have 1 here, so a fit that ends above 1 has failed.
    """
    if balanced:
        vectors = vectors.join(F.broadcast(balanced_weights(vectors)), "label")
    weight = F.col("class_weight") if balanced else F.lit(1.0)
    margin = vector_to_array("rawPrediction")[1] * (2 * F.col("label") - 1)
    loss = model.transform(vectors).agg(F.sum(weight * F.greatest(F.lit(0.0), 1 - margin)) / F.sum(weight)).first()[0]
    w = model.coefficients.toArray()
    return float(loss) + model.getRegParam() / 2 * float(w @ w)


def decision_scores(predicted: DataFrame) -> DataFrame:
    """Add ``score``: the margin, else P(class 1), else the label itself."""
    if "rawPrediction" in predicted.columns:
        score = vector_to_array("rawPrediction")[1]
    elif "probability" in predicted.columns:
        score = vector_to_array("probability")[1]
    else:
        score = F.col("prediction")
    return predicted.withColumn("score", score).withColumn("pred", F.col("prediction").cast("int"))


def feature_importance_linear(params: DataFrame, vocab: DataFrame, n: int = 20) -> DataFrame:
    """The n largest and the n smallest weights with their terms; noise of a sum does not decide ties."""
    named = params.join(vocab.select("term", "term_idx"), "term_idx").withColumn("w", F.round("w", 12))
    up = named.orderBy(F.desc("w"), "term").limit(n).withColumn("side", F.lit("positive"))
    down = named.orderBy("w", "term").limit(n).withColumn("side", F.lit("negative"))
    return up.unionByName(down).select("side", "term", "w")
