"""Score curves: ROC, precision-recall, areas, threshold sweeps, running metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from corpusmill.functions.numeric import safe_ratio
from corpusmill.session import materialize


def score_counts(df: DataFrame, *by: str, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score: ties become one row."""
    return df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) == 0, 1)).alias("neg"))


def score_splits(counts: DataFrame, buckets: int | None = None) -> list[float]:
    """Bucket borders with about equally many distinct scores between them.

    They only spread the work: any borders give the same curve. There are as
    many as shuffle partitions.
    """
    buckets = max(2, buckets or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = counts.approxQuantile("score", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    return [float("-inf"), *sorted(set(cuts)), float("inf")]


@dataclass(frozen=True)
class ScoreTable:
    """Written counts per score with the borders of their buckets, for any number of curves.

    The scored rows are computed once, when the table is written; borders and
    curves read the narrow table only.
    """

    counts: DataFrame
    splits: list[float]
    by: tuple[str, ...] = ()

    @classmethod
    def of(cls, df: DataFrame | ScoreTable, *by: str, splits: list[float] | None = None) -> ScoreTable:
        if isinstance(df, cls):
            return df
        counts = materialize(score_counts(df, *by), "score-counts")
        return cls(counts, score_splits(counts) if splits is None else splits, by)


def cumulative(table: ScoreTable) -> DataFrame:
    """Add tp and fp: positives and negatives at or above each score.

    A window over all scores would be one task. Scores are put into ordered
    buckets; each bucket runs its own window and starts from the total of the
    buckets above, which is a table of one row per bucket and group.
    """
    by = table.by
    splits = table.splits if len(table.splits) > 2 else [float("-inf"), 0.0, float("inf")]
    put = Bucketizer(splits=splits, inputCol="score", outputCol="_bucket").transform(table.counts)
    above = Window.partitionBy(*by).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (put.groupBy(*by, "_bucket").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
               .select(*by, "_bucket", F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p0"),
                       F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n0")))
    inside = Window.partitionBy(*by, "_bucket").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ran = put.withColumn("_pc", F.sum("pos").over(inside)).withColumn("_nc", F.sum("neg").over(inside))
    return ran.join(offsets, [*by, "_bucket"]).select(
        *by, "score", "pos", "neg",
        (F.col("_pc") + F.col("_p0")).alias("tp"), (F.col("_nc") + F.col("_n0")).alias("fp"))


def _with_totals(table: ScoreTable) -> DataFrame:
    running, by = cumulative(table), table.by
    totals = table.counts.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    if by:
        return running.join(totals, list(by))
    return running.withColumns({"n_pos": totals.select("n_pos").scalar(),
                                "n_neg": totals.select("n_neg").scalar()})


def roc_curve(df: DataFrame | ScoreTable, *by: str, splits: list[float] | None = None) -> DataFrame:
    """(threshold, tpr, fpr) per distinct score, after the (0, 0) start point."""
    table = ScoreTable.of(df, *by, splits=splits)
    points = _with_totals(table).select(
        *table.by, F.col("score").alias("threshold"),
        safe_ratio(F.col("tp"), F.col("n_pos")).alias("tpr"),
        safe_ratio(F.col("fp"), F.col("n_neg")).alias("fpr"))
    start = table.counts.select(*table.by).distinct() if table.by else table.counts.sparkSession.range(1)
    return start.select(*table.by, F.lit(None).cast("double").alias("threshold"),
                        F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr")).unionByName(points)


def pr_curve(df: DataFrame | ScoreTable, *by: str, splits: list[float] | None = None) -> DataFrame:
    table = ScoreTable.of(df, *by, splits=splits)
    return _with_totals(table).select(
        *table.by, F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        safe_ratio(F.col("tp"), F.col("n_pos")).alias("recall"))


def auc_roc(df: DataFrame | ScoreTable, *by: str, splits: list[float] | None = None) -> DataFrame:
    """Area by the trapezoid rule, ties included; 0.5 with a single class."""
    table = ScoreTable.of(df, *by, splits=splits)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return cumulative(table).groupBy(*table.by).agg(
        F.when(pairs > 0, area / pairs).otherwise(F.lit(0.5)).alias("auc_roc"))


def average_precision(df: DataFrame | ScoreTable, *by: str, splits: list[float] | None = None) -> DataFrame:
    """Sum of recall steps times precision."""
    table = ScoreTable.of(df, *by, splits=splits)
    steps = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return cumulative(table).groupBy(*table.by).agg(safe_ratio(steps, F.sum("pos")).alias("average_precision"))


def threshold_sweep(df: DataFrame, steps: int = 100, label: str = "label", score: str = "score") -> DataFrame:
    """Rates at ``steps`` thresholds from 1 down to 0.

    Every score goes to the first threshold it reaches, so the data is read
    once and the running sums are over ``steps`` rows, whatever its size.
    """
    last = steps - 1

    def level(k):
        return F.when(k >= last, F.lit(0.0)).otherwise(k * F.lit(-1.0 / last) + F.lit(1.0))

    s = F.col(score)
    guess = F.greatest(F.lit(0), F.least(F.lit(last), F.ceil((F.lit(1.0) - s) * last).cast("int")))
    # The guess can be one off by rounding; compare with the level itself.
    exact = (F.when((guess > 0) & (s >= level(guess - 1)), guess - 1)
             .when(s < level(guess), guess + 1).otherwise(guess))
    hits = df.select(exact.alias("step"), label).groupBy("step").agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) == 0, 1)).alias("neg"))
    levels = df.sparkSession.range(steps).select(F.col("id").cast("int").alias("step"))
    upto = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grid = (levels.join(hits, "step", "left").fillna(0, ["pos", "neg"])
            .withColumn("tp", F.sum("pos").over(upto)).withColumn("fp", F.sum("neg").over(upto)))
    n_pos = hits.agg(F.sum("pos")).scalar()
    n_neg = hits.agg(F.sum("neg")).scalar()
    tp, fp = F.col("tp"), F.col("fp")
    return grid.select(
        "step", level(F.col("step")).alias("threshold"),
        safe_ratio(tp, n_pos).alias("tpr"), safe_ratio(fp, n_neg).alias("fpr"),
        safe_ratio(tp, tp + fp, 1.0).alias("precision"), safe_ratio(tp, n_pos).alias("recall"))


def sweep_auc(sweep: DataFrame) -> DataFrame:
    """Trapezoid area and plain mean precision of the sweep's rows."""
    order = Window.orderBy("step")
    step = sweep.withColumns({"_f": F.lag("fpr").over(order), "_t": F.lag("tpr").over(order)})
    area = (F.col("fpr") - F.col("_f")) * (F.col("tpr") + F.col("_t")) / 2.0
    return step.agg(F.sum(area).alias("sweep_auc"), F.avg("precision").alias("mean_precision_100"))


def running_metrics(df: DataFrame, batch_size: int = 500) -> DataFrame:
    """Confusion counts of the first 1, 2, 3... batches in ``doc_id`` order.

    Row positions come from per-range counts: rows are ordered inside ranges of
    doc_id, and a range starts where the ones before it end.
    """
    buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df = materialize(df.select("doc_id", "label", "pred"), "predictions")
    borders = df.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    splits = [float("-inf"), *sorted(set(borders)), float("inf")]
    put = Bucketizer(splits=splits, inputCol="_id", outputCol="_range").transform(
        df.select("doc_id", "label", "pred", F.col("doc_id").cast("double").alias("_id")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (put.groupBy("_range").agg(F.count("*").alias("_n"))
               .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("_range").orderBy("doc_id")
    # The offset table has one row per bucket.
    numbered = (put.withColumn("_rn", F.row_number().over(inside)).join(F.broadcast(offsets), "_range")
                .withColumn("batch", F.floor((F.col("_rn") + F.col("_start") - 1) / batch_size).cast("long")))
    return accumulate_batches(batch_counts(numbered))


def batch_counts(df: DataFrame) -> DataFrame:
    from corpusmill.operators.metrics import confusion_counts
    return confusion_counts(df, "batch")


def accumulate_batches(counts: DataFrame) -> DataFrame:
    """Running sums over the per-batch counts (one narrow row per batch)."""
    from corpusmill.operators.metrics import binary_metrics
    # Blocks of batches, so that a long stream does not end in one task.
    block = F.floor(F.col("batch") / 4096)
    blocked = counts.withColumn("_block", block)
    names = ("tp", "tn", "fp", "fn")
    prior = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy("_block").agg(*[F.sum(c).alias(f"_{c}") for c in names])
    offsets = totals.select("_block", *[
        F.coalesce(F.sum(f"_{c}").over(prior), F.lit(0)).alias(f"_{c}") for c in names])
    inside = Window.partitionBy("_block").orderBy("batch").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ran = blocked.select("batch", "_block", *[F.sum(c).over(inside).alias(c) for c in names])
    joined = ran.join(offsets, "_block").select(
        "batch", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in names])
    return binary_metrics(joined)
