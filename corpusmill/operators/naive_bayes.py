"""Naive Bayes in DataFrame form: multinomial, Bernoulli and complement.

With two classes each kind is a linear scorer: one weight per term and one
bias. Fitting is a single aggregation by term, and k-fold cross-validation over
any number of alphas is a single pass as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions.numeric import sigmoid
from corpusmill.session import broadcast_bounded, materialize

KINDS = ("MNB", "BNB", "CNB")


def label_term_sums(weights: DataFrame, *by: str) -> DataFrame:
    """Per term: weight sums f0, f1 and document counts d0, d1 of both classes."""
    zero, one = F.col("label") == 0, F.col("label") == 1
    return weights.groupBy(*by, "term_idx").agg(
        F.coalesce(F.sum(F.when(zero, F.col("weight"))), F.lit(0.0)).alias("f0"),
        F.coalesce(F.sum(F.when(one, F.col("weight"))), F.lit(0.0)).alias("f1"),
        F.count(F.when(zero & (F.col("weight") > 0), 1)).alias("d0"),
        F.count(F.when(one & (F.col("weight") > 0), 1)).alias("d1"))


def _bernoulli_p(d: str, n: str, alpha: float) -> Column:
    return (F.col(d) + alpha) / (F.col(n) + 2 * alpha)


def term_weight(kind: str, alpha: float) -> Column:
    """Weight of a term for class 1 against class 0.

    Reads f0, f1, d0, d1 of the term, class sizes n0, n1 and, over all terms,
    t0 = sum f0, t1 = sum f1 and the term number v.
    """
    f0, f1, t0, t1, v = (F.col(c) for c in ("f0", "f1", "t0", "t1", "v"))
    if kind == "MNB":
        return F.ln((f1 + alpha) / (t1 + alpha * v)) - F.ln((f0 + alpha) / (t0 + alpha * v))
    if kind == "BNB":
        p0, p1 = _bernoulli_p("d0", "n0", alpha), _bernoulli_p("d1", "n1", alpha)
        return F.ln(p1 / (1 - p1)) - F.ln(p0 / (1 - p0))
    if kind == "CNB":
        # The complement of a class is the other class.
        return F.ln((f1 + alpha) / (t1 + alpha * v)) - F.ln((f0 + alpha) / (t0 + alpha * v))
    raise ValueError(f"unknown kind: {kind}")


def absent_weight(alpha: float) -> Column:
    """What a Bernoulli term adds to the bias before it is seen."""
    return (F.ln(1 - _bernoulli_p("d1", "n1", alpha)) - F.ln(1 - _bernoulli_p("d0", "n0", alpha)))


def class_prior(kind: str) -> Column:
    """Log odds of the classes; a class without rows is never predicted."""
    if kind == "CNB":
        return F.lit(0.0)
    return (F.when(F.col("n1") == 0, F.lit(float("-inf"))).when(F.col("n0") == 0, F.lit(float("inf")))
            .otherwise(F.ln(F.try_divide("n1", "n0"))))


def class_sizes(docs: DataFrame, *by: str) -> DataFrame:
    return docs.groupBy(*by).agg(
        F.count(F.when(F.col("label") == 0, 1)).alias("n0"),
        F.count(F.when(F.col("label") == 1, 1)).alias("n1"))


@dataclass
class LinearScorer:
    """weights(term_idx, w) and a bias."""

    weights: DataFrame
    bias: float
    binarize: bool = False


def complete_terms(sums: DataFrame, vocab: DataFrame) -> DataFrame:
    """All vocabulary terms, zero sums where the training side has none."""
    return vocab.select("term_idx").join(sums, "term_idx", "left").fillna(0)


def fit_nb(weights: DataFrame, docs: DataFrame, vocab: DataFrame, kind: str = "MNB",
           alpha: float = 1.0, sums: DataFrame | None = None) -> LinearScorer:
    """Fit from training postings; ``docs`` gives the class sizes.

    The sums (one row per vocabulary term) are written, so the postings are read
    once and the model has no lineage; five totals come back to the driver.
    """
    sums = label_term_sums(weights) if sums is None else sums
    full = materialize(complete_terms(sums, vocab), "term_sums")
    n = class_sizes(docs).first()
    t = full.agg(F.sum("f0").alias("t0"), F.sum("f1").alias("t1"), F.count("*").alias("v")).first()
    known = full.withColumns({k: F.lit(x) for k, x in {**n.asDict(), **t.asDict()}.items()})
    absent = absent_weight(alpha) if kind == "BNB" else F.lit(0.0)
    bias = known.select(absent.alias("_a"), class_prior(kind).alias("_p")).agg(F.sum("_a") + F.max("_p")).first()[0]
    return LinearScorer(known.select("term_idx", term_weight(kind, alpha).alias("w")), float(bias), kind == "BNB")


def linear_margin(docs: DataFrame, weights: DataFrame, scorer: LinearScorer, max_features: int,
                  *keep: str) -> DataFrame:
    """(doc_id, ..., margin) for every document, also those without known terms."""
    side = broadcast_bounded(scorer.weights, max_features, 32)
    x = F.lit(1.0) if scorer.binarize else F.col("weight")
    dots = (weights.join(side, "term_idx").groupBy("doc_id").agg(F.sum(x * F.col("w")).alias("_dot")))
    return docs.select("doc_id", *keep).join(dots, "doc_id", "left").select(
        "doc_id", *keep,
        (F.coalesce("_dot", F.lit(0.0)) + F.lit(scorer.bias)).alias("margin"))


def with_prediction(margins: DataFrame) -> DataFrame:
    """Class 1 only on a strictly larger joint likelihood; P(class 1) beside it."""
    return margins.withColumns({"score": sigmoid(F.col("margin")),
                                "pred": (F.col("margin") > 0).cast("int")})


def predict_nb(docs: DataFrame, weights: DataFrame, scorer: LinearScorer, max_features: int,
               *keep: str) -> DataFrame:
    return with_prediction(linear_margin(docs, weights, scorer, max_features, *keep))


# --- cross-validation -------------------------------------------------------

def config_name(kind: str, alpha: float) -> str:
    return f"{kind}_{alpha:g}"


def leave_fold_out_sums(weights: DataFrame, k: int) -> DataFrame:
    """(fold, term_idx, f0, f1, d0, d1): sums over all folds but that one.

    One aggregation by term gives the sums of all k training sides; nothing is
    subtracted, so no cancellation enters.
    """
    def pick(f, label):
        return (F.col("fold") != f) & (F.col("label") == label)

    cells = []
    for f in range(k):
        cells.append(F.struct(
            F.lit(f).alias("fold"),
            *[F.coalesce(F.sum(F.when(pick(f, c), F.col("weight"))), F.lit(0.0)).alias(f"f{c}") for c in (0, 1)],
            *[F.count(F.when(pick(f, c) & (F.col("weight") > 0), 1)).alias(f"d{c}") for c in (0, 1)]))
    by_term = weights.groupBy("term_idx").agg(F.array(*cells).alias("_cells"))
    return by_term.select("term_idx", F.inline("_cells"))


def cv_scores(docs: DataFrame, weights: DataFrame, alphas: list[float],
              kinds: tuple[str, ...] = KINDS, k: int = 5, max_features: int = 20000) -> DataFrame:
    """Out-of-fold margins: (doc_id, fold, label, config, kind, alpha, margin).

    ``docs`` and ``weights`` carry ``fold``. Every (kind, alpha) is a column of
    the parameter table, so each posting is joined once for all of them. The
    vocabulary was fitted on the same rows: its terms all occur in ``weights``.
    """
    spark = docs.sparkSession
    grid = [(kind, a) for kind in kinds for a in alphas]
    sums = materialize(leave_fold_out_sums(weights, k), "fold_sums")
    sizes = docs.groupBy("fold").agg(F.count(F.when(F.col("label") == 0, 1)).alias("n0"),
                                     F.count(F.when(F.col("label") == 1, 1)).alias("n1")).collect()
    totals = sums.groupBy("fold").agg(
        F.sum("f0").alias("t0"), F.sum("f1").alias("t1"), F.count("*").alias("v")).collect()
    # k rows of constants per held-out fold.
    constants = F.broadcast(spark.createDataFrame(
        [(t.fold, sum(s.n0 for s in sizes if s.fold != t.fold), sum(s.n1 for s in sizes if s.fold != t.fold),
          t.t0, t.t1, t.v) for t in totals], "fold int, n0 long, n1 long, t0 double, t1 double, v long"))
    full = sums.join(constants, "fold")
    params = full.select("fold", "term_idx", *[
        term_weight(kind, a).alias(f"w{i}") for i, (kind, a) in enumerate(grid)])
    biases = full.groupBy("fold").agg(*[
        (F.coalesce(F.sum(absent_weight(a)), F.lit(0.0)) if kind == "BNB" else F.lit(0.0)).alias(f"a{i}")
        for i, (kind, a) in enumerate(grid)]).join(constants, "fold").select("fold", *[
            (F.col(f"a{i}") + class_prior(kind)).alias(f"b{i}") for i, (kind, _) in enumerate(grid)])
    side = broadcast_bounded(params, k * max_features, 8 * (len(grid) + 4))
    dots = weights.join(side, ["fold", "term_idx"]).groupBy("doc_id").agg(*[
        F.sum((F.lit(1.0) if kind == "BNB" else F.col("weight")) * F.col(f"w{i}")).alias(f"s{i}")
        for i, (kind, _) in enumerate(grid)])
    scored = (docs.select("doc_id", "fold", "label").join(dots, "doc_id", "left")
              .join(F.broadcast(biases), "fold"))
    cells = [F.struct(F.lit(kind).alias("kind"), F.lit(float(a)).alias("alpha"),
                      (F.coalesce(f"s{i}", F.lit(0.0)) + F.col(f"b{i}")).alias("margin"))
             for i, (kind, a) in enumerate(grid)]
    return scored.select("doc_id", "fold", "label", F.inline(F.array(*cells)))
