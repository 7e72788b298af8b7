"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in DuckDB's dialect."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double: both engines then print the same number."""
    return df.select(*[
        (F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
