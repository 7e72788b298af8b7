"""Documents to term postings and term statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions.text import ngrams, remove_stopwords, tokenize


def token_frame(docs: DataFrame, config: FeatureConfig = FeatureConfig(), *keep: str) -> DataFrame:
    tokens = remove_stopwords(tokenize(F.col("content"), config.strip_accents), config.stop_words)
    return docs.select("doc_id", *keep, tokens.alias("tokens"))


def gram_frame(docs: DataFrame, config: FeatureConfig = FeatureConfig(), *keep: str) -> DataFrame:
    grams = ngrams(F.col("tokens"), config.ngram_min, config.ngram_max)
    return token_frame(docs, config, *keep).select("doc_id", *keep, grams.alias("grams"))


def doc_terms(docs: DataFrame, config: FeatureConfig = FeatureConfig(), *keep: str) -> DataFrame:
    """One row per document with ``terms``: array of (term, tf).

    Equal terms are counted inside the row: the sorted grams are cut where the
    neighbour differs, so no (document, term) pair is ever shuffled.
    """
    ordered = gram_frame(docs, config, *keep).select(
        # sort_array compares natively; array_sort calls an interpreted comparator for every two grams.
        "doc_id", *keep, F.sort_array("grams").alias("_s"))
    is_edge = lambda i: ((i == 0) | (i == F.size("_s"))
                         | (F.get(F.col("_s"), i) != F.get(F.col("_s"), i - 1)))
    edged = ordered.select("doc_id", *keep, "_s", F.filter(
        F.sequence(F.lit(0), F.size("_s")), is_edge).alias("_e"))
    runs = F.slice("_e", F.lit(1), F.greatest(F.size("_e") - 1, F.lit(0)))
    return edged.select("doc_id", *keep, F.transform(runs, lambda start, i: F.struct(
        F.get(F.col("_s"), start).alias("term"),
        (F.get(F.col("_e"), i + 1) - start).cast("long").alias("tf"))).alias("terms"))


def postings(docs: DataFrame, config: FeatureConfig = FeatureConfig(), *keep: str) -> DataFrame:
    """(doc_id, ..., term, tf). Documents without terms have no row here."""
    # The outer form keeps Catalyst from evaluating the arrays a second time
    # in an inferred size filter below the generator.
    return (doc_terms(docs, config, *keep)
            .select("doc_id", *keep, F.inline_outer("terms"))
            .where(F.col("term").isNotNull()))


def term_stats(posts: DataFrame) -> DataFrame:
    """Corpus count and document count per term (map-side combined)."""
    return posts.groupBy("term").agg(
        F.sum("tf").cast("long").alias("cf"), F.count("*").alias("df"))


def count_step(count: Column) -> Column:
    """A step of a scale that rises with ``count``: exact below 4,096, 12 leading bits above, so under 220,000 steps in all."""
    shift = F.greatest(F.length(F.bin(count)) - 12, F.lit(0))
    return shift.cast("long") * 4096 + F.call_function("shiftright", count, shift)


def top_terms(stats: DataFrame, limit: int) -> DataFrame:
    """The most frequent terms, ties by name; at most ``limit`` rows.

    Terms are counted by steps of their count first. Only those from the step
    that holds the cut-off upwards are ordered, so no task gets more rows than
    ``limit`` and that one step.
    """
    per_step = stats.groupBy(count_step(F.col("cf")).alias("step")).agg(F.count("*").alias("n"))
    # The scale bounds the rows of this single-partition sum.
    reached = per_step.select("step", F.sum("n").over(Window.orderBy(F.desc("step"))).alias("reached"))
    cut = reached.where(F.col("reached") >= limit).agg(F.coalesce(F.max("step"), F.lit(-1))).scalar()
    return stats.where(count_step(F.col("cf")) >= cut).orderBy(F.desc("cf"), "term").limit(limit)


def ngram_growth(docs: DataFrame, config: FeatureConfig = FeatureConfig(),
                 n_values: tuple[int, ...] = (1, 2, 3), cap: int = 10000) -> DataFrame:
    """Feature count for every n-gram range, from one pass over the texts.

    A gram of n tokens has n - 1 blanks, so each distinct gram is counted once
    and belongs to all ranges of at least its size.
    """
    from dataclasses import replace

    wide = replace(config, ngram_min=1, ngram_max=max(n_values))
    grams = gram_frame(docs, wide).select(F.explode_outer("grams").alias("term"))
    sizes = (grams.where(F.col("term").isNotNull()).groupBy("term").agg(F.lit(1).alias("_one"))
             .groupBy((F.size(F.split("term", " "))).alias("n")).agg(F.count("*").alias("terms")))
    total = sizes.agg(*[
        F.least(F.coalesce(F.sum(F.when(F.col("n") <= n, F.col("terms"))), F.lit(0)), F.lit(cap))
        .cast("long").alias(str(n)) for n in n_values])
    return total.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("ngram_max"), F.col(str(n)).alias("n_features"))
        for n in n_values])).alias("r")).select("r.*")
