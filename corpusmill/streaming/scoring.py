"""Structured Streaming: scoring, running metrics, de-duplication on ingest.

Queries here use ``availableNow``: they take what has arrived, keep their
progress in a checkpoint folder, and can be started again at any time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.corpus import clean_frame, content_digest
from corpusmill.operators.metrics import binary_metrics
from corpusmill.operators.naive_bayes import LinearScorer, predict_nb
from corpusmill.operators.tfidf import FittedFeatures
from corpusmill.session import scratch_path

SCORE_BINS = 100


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def stream_score(records: DataFrame, fitted: FittedFeatures, scorer: LinearScorer, out: str,
                 checkpoint: str, *keep: str) -> StreamingQuery:
    """Score arriving documents into ``out``, one folder per micro-batch.

    Every micro-batch goes through the batch operators. Its folder is
    overwritten when the batch is repeated after a failure, so no row is
    written twice. ``fitted`` and ``scorer`` should come from written tables.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        cleaned = clean_frame(batch, fitted.config)
        scored = predict_nb(cleaned, fitted.transform(cleaned), scorer, fitted.config.max_features, *keep)
        scored.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def running_state(scored: DataFrame) -> DataFrame:
    """Streaming counts per score bin: SCORE_BINS rows of state, whatever the volume."""
    score_bin = F.least(F.floor(F.col("score") * SCORE_BINS), F.lit(SCORE_BINS - 1)).cast("int")
    y, p = F.col("label"), F.col("pred")

    def n(cond):
        return F.count(F.when(cond, 1))

    return scored.groupBy(score_bin.alias("score_bin")).agg(
        n((y == 1) & (p == 1)).alias("tp"), n((y == 0) & (p == 0)).alias("tn"),
        n((y == 0) & (p == 1)).alias("fp"), n((y == 1) & (p == 0)).alias("fn"))


def stream_running_metrics(scored: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Rewrite the running state after each micro-batch (complete mode)."""
    def write(state: DataFrame, batch_id: int) -> None:
        state.withColumn("after_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/state={batch_id}")

    return (running_state(scored).writeStream.outputMode("complete").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def metrics_after_batches(state: DataFrame) -> DataFrame:
    """Metric record per finished micro-batch; AUC at the resolution of the bins."""
    higher = Window.partitionBy("after_batch").orderBy(F.desc("score_bin")).rowsBetween(Window.unboundedPreceding, -1)
    pos, neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    ranked = state.withColumns({"_p": pos, "_n": neg}).withColumn("_up", F.coalesce(F.sum("_p").over(higher), F.lit(0)))
    area = F.sum(F.col("_n") * (F.col("_up") + F.col("_p") / 2.0))
    pairs = F.sum("_p").cast("double") * F.sum("_n")
    totals = ranked.groupBy("after_batch").agg(
        *[F.sum(c).alias(c) for c in ("tp", "tn", "fp", "fn")],
        F.when(pairs > 0, area / pairs).otherwise(F.lit(0.5)).alias("auc_binned"))
    return binary_metrics(totals)


def stream_dedup(records: DataFrame, event_time: str | None = None, horizon: str = "7 days") -> DataFrame:
    """First arrival of every content.

    With an event time, keys older than the horizon leave the state; without
    one the state holds a digest of every content seen so far.
    """
    keyed = records.withColumn("content_hash", content_digest(F.col("content")))
    if event_time is None:
        return keyed.dropDuplicates(["content_hash"])
    return keyed.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["content_hash"])


def append_to(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.outputMode("append").format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


@dataclass
class Progress:
    """What a run of a stream left: rows of state, and the rows it refused as late."""

    state_rows: int
    late_rows: int


def run_arrivals(spark: SparkSession, parts: list[DataFrame], folder: str, start) -> list[Progress]:
    """Write one part after the other into ``folder``, and start the stream again after each.

    ``start(stream)`` starts a query that takes what has arrived; it finds its
    place by its checkpoint. Empty parts give a run without rows.
    """
    done = []
    for part in parts:
        part.write.mode("append").parquet(folder)
        query = start(read_stream(spark, folder, part.schema))
        finish(query)
        states = [op for p in query.recentProgress for op in p["stateOperators"]]
        done.append(Progress(states[-1]["numRowsTotal"] if states else 0, sum(op["numRowsDroppedByWatermark"] for op in states)))
    return done


def stream_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"
