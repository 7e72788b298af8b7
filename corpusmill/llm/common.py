"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from corpusmill.session import BROADCAST_LIMIT_BYTES, materialize

__all__ = ["broadcast_measured", "materialize", "map_rows", "never_broadcast", "read_table", "slices", "utf8"]

ROWS_AT_ONCE = 1000     # of an Arrow batch, to bound what a Python worker holds


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``ROWS_AT_ONCE`` rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch, ``ROWS_AT_ONCE`` rows at a time; it returns the columns of ``schema``."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], types[n]) for n in names], names)

    types = {f.name: to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)}
    return df.mapInArrow(run, schema)


def broadcast_measured(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT_BYTES // 4) -> DataFrame:
    """Broadcast a written table whose counted rows stay under ``limit`` bytes.

    ``row_bytes`` bounds the width of a row. Above the limit Spark shuffles
    both sides and splits skewed partitions.
    """
    most = max(1, limit // row_bytes)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else never_broadcast(df)


def never_broadcast(df: DataFrame) -> DataFrame:
    """``df`` for a join that sends neither side whole to the driver and the executors.

    Spark takes a table for as large as its file, and does not count the rows
    that an explode adds: left alone it may broadcast many times its limit.
    """
    return df.hint("merge")
