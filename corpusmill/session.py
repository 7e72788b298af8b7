"""Session building, shared scratch space and checked broadcasts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, functions as F

# A hint is given only to a side whose rows x width stays under this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = 8, app: str = "corpusmill") -> SparkSession:
    """Session for tests and the bench on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Small tables still fan out over all local cores before text work.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, for sessions started where it is not installed.

    On a cluster install it on the workers, or call this once per session. The
    driver serves the archive, so it stays until the driver ends.
    """
    _ship(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _ship(application: str) -> None:
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusmill-package-")
    SparkContext.getOrCreate().addPyFile(shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name))


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="corpusmill-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(docs: DataFrame) -> DataFrame:
    """Rows dealt by ``doc_id`` to at least two tasks a core before work on their texts.

    The number is given, as tables of texts are few files of few bytes: Spark
    would read and merge them into tasks of many megabytes each and leave cores idle.
    """
    spark = docs.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return docs.repartition(tasks, "doc_id")


def broadcast_bounded(df: DataFrame, max_rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast when the largest possible side is small enough.

    ``max_rows`` must be a bound that the operator guarantees (vocabulary cap,
    number of classes or folds). Beyond the limit the join is left to Spark.
    """
    if max_rows * row_bytes <= BROADCAST_LIMIT_BYTES:
        return F.broadcast(df)
    return df
