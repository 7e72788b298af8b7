"""Row fingerprints, change detection and column encryption."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _sha3_256(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: hashlib.sha3_256(t.encode("utf-8")).hexdigest(), na_action="ignore")


def row_text(columns: list[str]) -> Column:
    """Unambiguous text of a row: every value follows its length, a null is a dash."""
    values = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("-")) for v in values])


def row_fingerprint(df: DataFrame, columns: list[str], algo: str = "sha2_256") -> DataFrame:
    """``sha2_256`` stays in the JVM; ``sha3_256`` goes through Arrow batches."""
    text = row_text(columns)
    if algo == "sha2_256":
        digest = F.sha2(text, 256)
    elif algo == "sha3_256":
        digest = _sha3_256(text)
    else:
        raise ValueError(f"unknown digest: {algo}")
    return df.withColumn("fingerprint", digest)


def integrity_diff(manifest: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, status): added, removed, changed or same against the manifest."""
    old = manifest.select(key, F.col("fingerprint").alias("_old"))
    new = current.select(key, F.col("fingerprint").alias("_new"))
    status = (F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
              .when(F.col("_old") == F.col("_new"), "same").otherwise("changed"))
    return old.join(new, key, "full_outer").select(key, status.alias("status"))


def key_frame(path: str, spark) -> DataFrame:
    """One-row frame (key) from a secret file, read by the job that needs it."""
    return spark.read.text(path).select(F.trim("value").cast("binary").alias("key")).limit(1)


def encrypt_column(df: DataFrame, column: str, key: Column, mode: str = "GCM") -> DataFrame:
    """AES of a text column as base64; GCM by default, ECB for parity only."""
    padding = "DEFAULT" if mode == "GCM" else "PKCS"
    sealed = F.aes_encrypt(F.col(column).cast("binary"), key, F.lit(mode), F.lit(padding))
    return df.withColumn(column, F.base64(sealed))


def decrypt_column(df: DataFrame, column: str, key: Column, mode: str = "GCM") -> DataFrame:
    padding = "DEFAULT" if mode == "GCM" else "PKCS"
    opened = F.aes_decrypt(F.unbase64(F.col(column)), key, F.lit(mode), F.lit(padding))
    return df.withColumn(column, opened.cast("string"))
