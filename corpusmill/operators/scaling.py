"""Dense column normalisation with reusable parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def fit_normalization(df: DataFrame, columns: list[str], method: str = "standardize") -> dict:
    """One aggregation; two numbers per column come back to the driver."""
    if method == "standardize":
        aggs = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("a", F.avg), ("b", F.stddev_pop))]
    elif method == "minmax":
        aggs = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("a", F.min), ("b", F.max))]
    else:
        raise ValueError("method must be 'standardize' or 'minmax'")
    got = df.agg(*aggs).first()
    params = {}
    for c in columns:
        shift, other = got[f"{c}_a"], got[f"{c}_b"]
        spread = other if method == "standardize" else other - shift
        params[c] = (float(shift), float(spread) if spread else 1.0)
    return params


def apply_normalization(df: DataFrame, params: dict) -> DataFrame:
    """(x - shift) / spread; a spread of 0 was stored as 1."""
    return df.withColumns({c: (F.col(c) - F.lit(a)) / F.lit(b) for c, (a, b) in params.items()})
