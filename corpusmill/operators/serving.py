"""Batch inference on new documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusmill.functions.numeric import class_name
from corpusmill.functions.text import preview
from corpusmill.operators.corpus import clean_frame, require_columns
from corpusmill.operators.metrics import confusion_counts, weighted_metrics
from corpusmill.operators.naive_bayes import LinearScorer, fit_nb, predict_nb
from corpusmill.operators.tfidf import FittedFeatures


def transform_records(records: DataFrame, fitted: FittedFeatures, scaled: bool = False) -> DataFrame:
    """Raw title/text rows to weighted postings with the fitted artefacts."""
    require_columns(records, fitted.config)
    return fitted.transform(clean_frame(records, fitted.config), scaled=scaled)


def predict_batch(records: DataFrame, fitted: FittedFeatures, scorer: LinearScorer,
                  probabilities: bool = True) -> DataFrame:
    """doc_id, label if present, pred, class name and optionally both probabilities."""
    cleaned = clean_frame(require_columns(records, fitted.config), fitted.config)
    keep = [c for c in ("label",) if c in cleaned.columns]
    weights = fitted.transform(cleaned)
    scored = predict_nb(cleaned, weights, scorer, fitted.config.max_features, *keep)
    out = scored.withColumn("pred_class", class_name(F.col("pred")))
    if probabilities:
        return out.withColumns({"real_probability": F.col("score"), "fake_probability": 1.0 - F.col("score")})
    return out.drop("score", "margin")


def predict_table(records: DataFrame, fitted: FittedFeatures, scorer: LinearScorer):
    """(predictions, metrics or None): metrics need a label column."""
    predicted = predict_batch(records, fitted, scorer)
    if "label" not in predicted.columns:
        return predicted, None
    return predicted, weighted_metrics(confusion_counts(predicted))


def scorer_for(sums: DataFrame, docs: DataFrame, vocab: DataFrame, kind: str | None, alpha: float | None,
               best: tuple[str, float] | None = None) -> LinearScorer:
    """A model for the asked parameters, derived from stored sums, not from texts."""
    if kind is None:
        kind = best[0] if best else "BNB"
    if alpha is None:
        alpha = best[1] if best and best[0] == kind else 1.0
    return fit_nb(None, docs, vocab, kind, alpha, sums=sums)


def predict_one(spark, title: str, text: str, fitted: FittedFeatures, scorer: LinearScorer) -> DataFrame:
    one = spark.createDataFrame([(0, title, text)], "doc_id long, title string, text string")
    return predict_batch(one, fitted, scorer)


def align_predictions(records: DataFrame, predicted: DataFrame) -> DataFrame:
    """The per-row prediction report: title, short text, labels, names, verdict."""
    return (records.select("doc_id", "title", "text", F.col("label").alias("true_label"))
            .join(predicted.select("doc_id", F.col("pred").alias("predicted_label")), "doc_id")
            .select("doc_id", "title", preview(F.col("text")).alias("text"), "true_label", "predicted_label",
                    class_name(F.col("true_label")).alias("true_class"),
                    class_name(F.col("predicted_label")).alias("predicted_class"),
                    (F.col("true_label") == F.col("predicted_label")).alias("correct")))
