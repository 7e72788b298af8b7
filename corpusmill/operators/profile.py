"""Corpus profile: class balance, lengths, vocabulary, leakage, top terms."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions.numeric import histogram_bin
from corpusmill.functions.text import build_content, has_email, has_url, word_count
from corpusmill.operators.terms import postings, term_stats, top_terms
from corpusmill.operators.tfidf import fit_vocabulary, row_count, tfidf_transform
from corpusmill.session import broadcast_bounded


def class_counts(df: DataFrame) -> DataFrame:
    """One row; a class without documents counts 0."""
    return df.agg(
        F.count(F.when(F.col("label") == 0, 1)).alias("fake_0"),
        F.count(F.when(F.col("label") == 1, 1)).alias("real_1"))


def class_ratios(df: DataFrame) -> DataFrame:
    counts = df.groupBy("label").agg(F.count("*").alias("n"))
    # One row per class under this window.
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(Window.partitionBy()))


def imbalance_verdict(df: DataFrame) -> DataFrame:
    one = class_counts(df).withColumn("total", F.col("fake_0") + F.col("real_1"))
    shares = one.withColumns({
        "fake_percent": F.try_divide(F.col("fake_0") * 100.0, "total"),
        "real_percent": F.try_divide(F.col("real_1") * 100.0, "total")})
    gap = F.abs(F.col("fake_percent") - F.col("real_percent"))
    return shares.withColumn(
        "verdict", F.when(F.col("fake_0") == F.col("real_1"), "Perfectly Balanced")
        .when(gap < 10, "Roughly Balanced").otherwise("Imbalanced"))


def with_length(df: DataFrame) -> DataFrame:
    return df.withColumn("words", word_count(F.col("content")))


def length_stats(df: DataFrame, *by: str) -> DataFrame:
    """Word-count mean, exact median, min and max."""
    return with_length(df).groupBy(*by).agg(
        F.avg("words").alias("mean_words"), F.median("words").alias("median_words"),
        F.min("words").cast("long").alias("min_words"), F.max("words").cast("long").alias("max_words"))


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over each group's own range, empty ones included.

    The range table has one row per group; ``by`` is a class column. Values
    that are null are not counted; a group without values has no bins.
    """
    keys = [by] if by else []
    ranges = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    if by:
        ranged = df.select(by, value).join(ranges, by)
        low, high = F.col("_low"), F.col("_high")
    else:
        ranges = ranges.where(F.col("_low").isNotNull())
        ranged = df.select(value)
        low = ranges.select("_low").scalar()
        high = ranges.select("_high").scalar()
    counted = ranged.where(F.col(value).isNotNull()).groupBy(*keys, histogram_bin(F.col(value), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    every = ranges.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(bins)).cast("array<bigint>")).alias("bin"))
    return every.join(counted, [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def length_histogram(df: DataFrame, bins: int = 60, by: str | None = None) -> DataFrame:
    return histogram(with_length(df), "words", bins, by)


def vocab_richness(df: DataFrame, max_features: int = 5000,
                   config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Distinct capped-vocabulary tokens per document; documents may have 0."""
    plain = replace(config, ngram_min=1, ngram_max=1, strip_accents=None)
    posts = postings(df, plain)
    capped = broadcast_bounded(top_terms(term_stats(posts), max_features).select("term"),
                               max_features, 96)
    per_doc = posts.join(capped, "term", "left_semi").groupBy("doc_id").agg(
        F.count("*").alias("unique_tokens"))
    return df.select("doc_id").join(per_doc, "doc_id", "left").select(
        "doc_id", F.coalesce("unique_tokens", F.lit(0)).cast("long").alias("unique_tokens"))


def vocab_richness_stats(df: DataFrame, max_features: int = 5000) -> DataFrame:
    return vocab_richness(df, max_features).agg(
        F.avg("unique_tokens").alias("mean_unique"), F.median("unique_tokens").alias("median_unique"),
        F.min("unique_tokens").alias("min_unique"), F.max("unique_tokens").alias("max_unique"))


def leakage_rates(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Share of documents (in %) with links or addresses, before and after."""
    def rates(df, stage):
        return df.select(
            F.lit(stage).alias("stage"),
            (F.avg(has_url(F.col("content")).cast("double")) * 100).alias("pct_url"),
            (F.avg(has_email(F.col("content")).cast("double")) * 100).alias("pct_email"))
    before = raw.select(build_content(F.col("title"), F.col("text")).alias("content"))
    return rates(before, "raw").unionByName(rates(cleaned.select("content"), "cleaned"))


def eda_config(max_features: int = 10000) -> FeatureConfig:
    """The profile's vectoriser: no document-frequency limits."""
    return FeatureConfig(max_features=max_features, min_df=1, max_df=1.0)


def class_mean_weights(docs: DataFrame, config: FeatureConfig | None = None) -> DataFrame:
    """Mean TF-IDF weight per class and term, zeros included.

    Fitted on the given documents; one aggregation on the term carries both
    classes, so a frequent term is combined on the map side.
    """
    config = config or eda_config()
    vocab = fit_vocabulary(docs, config)
    weights = tfidf_transform(docs, vocab, config, "label")
    counts = docs.groupBy("label").agg(F.count("*").alias("class_n"))
    sums = weights.groupBy("label", "term").agg(F.sum("weight").alias("_w"))
    return sums.join(counts, "label").select(
        "label", "term", (F.col("_w") / F.col("class_n")).alias("mean_weight"))


def rank_terms(means: DataFrame) -> DataFrame:
    """Rank inside each class; the input is capped by the vocabulary.

    Means that differ by the noise of a sum are ties, broken by name.
    """
    order = Window.partitionBy("label").orderBy(F.desc(F.round("mean_weight", 12)), "term")
    return means.withColumn("rank", F.row_number().over(order))


def top_tokens_per_class(docs: DataFrame, k: int = 20, config: FeatureConfig | None = None) -> DataFrame:
    return rank_terms(class_mean_weights(docs, config)).where(F.col("rank") <= k)


def corpus_stats(split: DataFrame, vocab: DataFrame, config: FeatureConfig = FeatureConfig(), subjects: DataFrame | None = None) -> DataFrame:
    """One row per side: sizes, feature counts (of the texts and with the one-hot block), class counts."""
    n_text = row_count(vocab)
    n_total = n_text + F.lit(0 if subjects is None else subjects.count()).cast("long")
    return split.groupBy("split").agg(
        F.count("*").alias("n_samples"),
        F.count(F.when(F.col("label") == 0, 1)).alias("fake_0"),
        F.count(F.when(F.col("label") == 1, 1)).alias("real_1"),
    ).select("*", n_text.alias("n_features_text"), n_total.alias("n_features_total"), F.lit(config.include_subject).alias("include_subject"),
             F.lit(config.produce_scaled).alias("scaled"))
