"""One registered query per operator of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.llm import align, html, imatch, langid, pareto, pii, pq, simhash, suffix, toxicity, warc, whiten, winnow
from corpusmill.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_pareto_mix", pareto.MIX_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto.mix_sources(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_pii_bootstrap")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


@query("op3_winnowing", winnow.CONTAMINATION_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op4_toxic_lexicon")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op5_suffix_trees", suffix.REPEATS_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.drop_repeated_spans(read_table(spark, sf_dir, "documents"), keep_text=False)


@query("op6_imatch")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(read_table(spark, sf_dir, "documents"))


@query("op7_language_ecoc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_of(read_table(spark, sf_dir, "documents"))


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(read_table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         F.col("component").alias("component_id"))


@query("op9_html_gbt")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(read_table(spark, sf_dir, "pages"))


@query("op10_warc_zstd", warc.ARCHIVE_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.components_of(whiten.whiten(read_table(spark, sf_dir, "embeddings"))).withColumnRenamed("id", "vec_id")


@query("op12_pq_near_duplicates")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_documents(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
