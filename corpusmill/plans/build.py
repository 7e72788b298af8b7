"""The feature build: raw labelled rows in, tables and metadata out.

Each step reads what the step before has written. The texts are cleaned,
de-duplicated and shuffled once, and lost executors cost a stage, not the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.config import FeatureConfig
from corpusmill.operators.corpus import prepare_corpus
from corpusmill.operators.profile import corpus_stats
from corpusmill.operators.split import stratified_split
from corpusmill.operators.tfidf import (
    FittedFeatures, apply_scale, fit_scale, fit_subjects, fit_vocabulary, row_count, sparse_rows,
    subject_onehot, tfidf_transform, with_subject_features,
)
from corpusmill.sources.sinks import read_features, write_features, write_run_metadata

VOCAB_SCHEMA = "term string, term_idx int, cf long, df long, idf double"


@dataclass
class BuiltFeatures:
    spark: SparkSession
    path: str
    config: FeatureConfig

    def corpus(self) -> DataFrame:
        subject = ", subject string" if self.config.include_subject else ""
        return self.spark.read.schema(f"doc_id long, label int, content string{subject}, split string").parquet(
            f"{self.path}/corpus")

    def features(self, scaled: bool, split: str | None = None) -> DataFrame:
        return read_features(self.spark, f"{self.path}/features", scaled, split)

    def fitted(self) -> FittedFeatures:
        """Artefacts for new documents, read from their tables."""
        read = self.spark.read
        vocab = read.schema(VOCAB_SCHEMA).parquet(f"{self.path}/vocab")
        scale = subjects = None
        if self.config.produce_scaled:
            scale = read.schema("term_idx int, scale double").parquet(f"{self.path}/scale")
        if self.config.include_subject:
            subjects = read.schema("subject string, subject_idx int").parquet(f"{self.path}/subjects")
        return FittedFeatures(self.config, vocab, scale, subjects)

    def n_features(self) -> int:
        fitted = self.fitted()
        return fitted.vocab.count() + (fitted.subjects.count() if fitted.subjects is not None else 0)


def build_features(raw: DataFrame, path: str, config: FeatureConfig = FeatureConfig()) -> BuiltFeatures:
    spark = raw.sparkSession
    built = BuiltFeatures(spark, path, config)

    # The split needs two narrow passes over the prepared rows: write them first.
    prepare_corpus(raw, config).write.parquet(f"{path}/prepared")
    prepared = spark.read.parquet(f"{path}/prepared")
    stratified_split(prepared, config.test_size, config.random_state).write.partitionBy("split").parquet(f"{path}/corpus")

    corpus = built.corpus()
    train = corpus.where(F.col("split") == "train")
    fit_vocabulary(train, config).write.parquet(f"{path}/vocab")
    vocab = spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab")

    weights = tfidf_transform(corpus, vocab, config, "split").select("doc_id", "split", "term_idx", "weight")
    if config.include_subject:
        fit_subjects(train).write.parquet(f"{path}/subjects")
        onehot = subject_onehot(corpus, spark.read.parquet(f"{path}/subjects"))
        block = with_subject_features(weights, onehot, row_count(vocab))
        weights = block.join(corpus.select("doc_id", "split"), "doc_id")
    weights.write.partitionBy("split").parquet(f"{path}/weights")
    stored = spark.read.schema("doc_id long, term_idx int, weight double, split string").parquet(f"{path}/weights")

    docs = corpus.select("doc_id", "label", "split")
    write_features(sparse_rows(docs, stored, "label", "split"), f"{path}/features", scaled=False)
    if config.produce_scaled:
        fit_scale(stored.where(F.col("split") == "train"), row_count(train)).write.parquet(f"{path}/scale")
        scale = spark.read.parquet(f"{path}/scale")
        scaled = apply_scale(stored, scale, config.max_features)
        write_features(sparse_rows(docs, scaled, "label", "split"), f"{path}/features", scaled=True)
    write_run_metadata(spark, f"{path}/metadata", config, corpus_stats(docs, vocab, config, built.fitted().subjects))
    return built
