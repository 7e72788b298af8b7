"""Numeric expressions shared by models and metrics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(num: Column, den: Column, empty: float = 0.0) -> Column:
    return F.when(den != 0, num / den).otherwise(F.lit(empty))


def sigmoid(z: Column) -> Column:
    clipped = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clipped))


def log_loss_term(label: Column, proba: Column) -> Column:
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1.0 - 1e-15), proba))
    return -F.when(label == 1, F.ln(p)).otherwise(F.ln(F.lit(1.0) - p))


def sublinear_tf(tf: Column) -> Column:
    return F.lit(1.0) + F.ln(tf)


def smooth_idf(n_docs: Column, df: Column) -> Column:
    return F.ln((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def histogram_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bin; the last bin is closed on the right."""
    raw = F.floor((value - low) / (high - low) * bins) + 1
    return F.when(high == low, F.lit(bins // 2 + 1)).otherwise(F.least(raw, F.lit(bins))).cast("long")


def threshold_predict(proba: Column, threshold: float = 0.5) -> Column:
    return (proba >= threshold).cast("int")


def class_name(label: Column) -> Column:
    return F.when(label == 1, "Real News").otherwise("Fake News")
