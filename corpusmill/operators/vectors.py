"""Sparse ML vectors from sorted arrays, without Python per row."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from corpusmill.session import scratch_path


def write_vectors(rows: DataFrame, size: int, path: str, partition_by: list[str] | None = None) -> None:
    """Store ``idx``/``val`` as the columns a vector consists of."""
    stored = rows.withColumn("features", F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.col("idx").alias("indices"), F.col("val").alias("values"))).drop("idx", "val")
    writer = stored.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_vectors(spark, path: str, schema: StructType) -> DataFrame:
    """Read stored rows; ``schema`` names the other columns."""
    full = StructType([*schema.fields, StructField("features", VectorUDT())])
    return spark.read.schema(full).parquet(path)


def vector_frame(rows: DataFrame, size: int) -> DataFrame:
    """Rows with ``features`` as a sparse vector, through the shared folder."""
    spark = rows.sparkSession
    path = scratch_path(spark, "vectors")
    write_vectors(rows, size, path)
    others = StructType([f for f in rows.schema.fields if f.name not in ("idx", "val")])
    return read_vectors(spark, path, others)
