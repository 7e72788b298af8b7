"""TF-IDF: fitted on the training side, applied anywhere; scaling; one-hot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions.numeric import smooth_idf, sublinear_tf
from corpusmill.operators.terms import postings, term_stats, top_terms
from corpusmill.session import broadcast_bounded, materialize, spread

VOCAB_ROW_BYTES = 160


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery: no join, no driver round trip."""
    return df.agg(F.count("*")).scalar()


def fit_vocabulary(docs: DataFrame, config: FeatureConfig = FeatureConfig(),
                   posts: DataFrame | None = None) -> DataFrame:
    """vocab(term, term_idx, cf, df, idf); at most ``max_features`` rows.

    The counts of terms in enough documents are written: they are read twice, for the cut-off and for the terms above it.
    """
    posts = postings(spread(docs), config) if posts is None else posts
    n_docs = row_count(docs)
    stats = materialize(term_stats(posts).where(F.col("df") >= config.min_df), "term-stats").where(
        F.col("df") <= F.lit(config.max_df) * n_docs)
    kept = top_terms(stats, config.max_features)
    # The cap bounds this single-partition numbering.
    index = F.row_number().over(Window.orderBy("term")) - 1
    return kept.select("term", index.alias("term_idx"), "cf", "df",
                       smooth_idf(n_docs, F.col("df")).alias("idf"))


def vocab_lookup(posts: DataFrame, vocab: DataFrame, max_features: int) -> DataFrame:
    """Keep postings of known terms only."""
    return posts.join(broadcast_bounded(vocab, max_features, VOCAB_ROW_BYTES), "term")


def weigh(known: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Add the unit-length ``weight``; free of a shuffle when co-located by doc_id."""
    tf = sublinear_tf(F.col("tf")) if config.sublinear_tf else F.col("tf").cast("double")
    raw = known.withColumn("_raw", tf * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("doc_id")))
    return raw.withColumn("weight", F.col("_raw") / norm).drop("_raw")


def tfidf_transform(docs: DataFrame, vocab: DataFrame, config: FeatureConfig = FeatureConfig(),
                    *keep: str) -> DataFrame:
    """(doc_id, ..., term, term_idx, tf, weight) for in-vocabulary terms.

    The texts are spread by ``doc_id`` once, before they fan out: the norm of a
    document is then computed where its postings are made.
    """
    known = vocab_lookup(postings(spread(docs), config, *keep),
                         vocab.select("term", "term_idx", "idf"), config.max_features)
    return weigh(known, config).select("doc_id", *keep, "term", "term_idx", "tf", "weight")


def fit_scale(weights: DataFrame, n_docs: Column | int, *by: str) -> DataFrame:
    """Population deviation per term with implied zeros; 0 becomes 1."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    sums = weights.groupBy(*by, "term_idx").agg(
        F.sum("weight").alias("_s"), F.sum(F.col("weight") * F.col("weight")).alias("_q"))
    mean = F.col("_s") / n
    var = F.greatest(F.col("_q") / n - mean * mean, F.lit(0.0))
    # Rounding noise of a constant column must not turn into a tiny divisor.
    dev = F.when(var > F.lit(1e-15) * F.greatest(F.col("_q") / n, F.lit(1e-300)), F.sqrt(var))
    return sums.select(*by, "term_idx", F.coalesce(dev, F.lit(1.0)).alias("scale"))


def apply_scale(weights: DataFrame, scale: DataFrame, max_features: int | None) -> DataFrame:
    """Divide by the training scale; terms never seen in training keep theirs.

    Without a bound on the columns (categories are not bounded) Spark chooses the join.
    """
    side = scale.select("term_idx", "scale")
    side = side if max_features is None else broadcast_bounded(side, max_features, 32)
    return (weights.join(side, "term_idx", "left")
            .withColumn("weight", F.col("weight") / F.coalesce("scale", F.lit(1.0)))
            .drop("scale"))


def fit_subjects(docs: DataFrame) -> DataFrame:
    """(subject, subject_idx) in name order, one row per training category.

    Categories are an encoder's columns, so the table is as small as the
    feature space the caller is ready to hold.
    """
    names = docs.select("subject").distinct()
    return names.withColumn("subject_idx", F.row_number().over(Window.orderBy("subject")) - 1)


def subject_onehot(docs: DataFrame, subjects: DataFrame) -> DataFrame:
    """(doc_id, subject_idx, value): unknown subjects give no row, all zeros."""
    return docs.join(subjects, "subject").select(
        "doc_id", "subject_idx", F.lit(1.0).alias("value"))


def with_subject_features(weights: DataFrame, onehot: DataFrame, n_text: Column) -> DataFrame:
    """Append the one-hot block behind the text columns."""
    block = onehot.select("doc_id", (F.col("subject_idx") + n_text).cast("int").alias("term_idx"),
                          F.col("value").alias("weight"))
    return weights.select("doc_id", "term_idx", "weight").unionByName(block)


def sparse_rows(docs: DataFrame, weights: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, ..., idx, val): sorted arrays; no known token means empty ones.

    A row is bounded by the vocabulary, so the list cannot outgrow a task.
    """
    rows = weights.groupBy("doc_id").agg(F.sort_array(F.collect_list(
        F.struct(F.col("term_idx").cast("int").alias("i"), F.col("weight").alias("v")))).alias("_f"))
    return docs.select("doc_id", *keep).join(rows, "doc_id", "left").select(
        "doc_id", *keep,
        F.coalesce(F.col("_f.i"), F.array().cast("array<int>")).alias("idx"),
        F.coalesce(F.col("_f.v"), F.array().cast("array<double>")).alias("val"))


@dataclass
class FittedFeatures:
    """Everything needed to featurise new documents."""

    config: FeatureConfig
    vocab: DataFrame
    scale: DataFrame | None = None
    subjects: DataFrame | None = None

    def transform(self, docs: DataFrame, *keep: str, scaled: bool = False) -> DataFrame:
        """Weighted postings; with ``include_subject`` the one-hot block follows the text columns."""
        weights = tfidf_transform(docs, self.vocab, self.config, *keep)
        if self.config.include_subject:
            if self.subjects is None:
                raise ValueError("subject features requested but no encoder was fitted")
            block = docs.select("doc_id", *keep, "subject").join(self.subjects, "subject").select(
                "doc_id", *keep, F.col("subject").alias("term"), (F.col("subject_idx") + row_count(self.vocab)).cast("int").alias("term_idx"),
                F.lit(1).cast("long").alias("tf"), F.lit(1.0).alias("weight"))
            weights = weights.unionByName(block)
        if not scaled:
            return weights
        if self.scale is None:
            raise ValueError("scaled features requested but no scale was fitted")
        return apply_scale(weights, self.scale, None if self.config.include_subject else self.config.max_features)


def fit_features(train: DataFrame, config: FeatureConfig = FeatureConfig()) -> FittedFeatures:
    vocab = fit_vocabulary(train, config)
    subjects = fit_subjects(train) if config.include_subject else None
    fitted = FittedFeatures(config, vocab, None, subjects)
    if config.produce_scaled:
        fitted.scale = fit_scale(fitted.transform(train), row_count(train))
    return fitted
