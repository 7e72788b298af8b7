"""Classification metrics as expressions over confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions.numeric import safe_ratio

SIX_METRICS = ("accuracy", "precision", "recall", "sensitivity", "specificity", "f1_score")


def confusion_counts(df: DataFrame, *by: str, label: str = "label", pred: str = "pred") -> DataFrame:
    """tp, tn, fp, fn in one pass; one row per group (or one row)."""
    y, p = F.col(label), F.col(pred)

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return df.groupBy(*by).agg(
        n((y == 1) & (p == 1)).alias("tp"), n((y == 0) & (p == 0)).alias("tn"),
        n((y == 0) & (p == 1)).alias("fp"), n((y == 1) & (p == 0)).alias("fn"))


def _f1(p: Column, r: Column) -> Column:
    return safe_ratio(2.0 * p * r, p + r)


def binary_metrics(conf: DataFrame) -> DataFrame:
    """Positive-class metrics; 0 wherever a denominator is 0."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    recall = safe_ratio(tp, tp + fn)
    precision = safe_ratio(tp, tp + fp)
    return conf.withColumns({
        "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "sensitivity": recall,
        "specificity": safe_ratio(tn, tn + fp),
        "f1_score": _f1(precision, recall),
    })


def _per_class(conf: DataFrame) -> dict[int, tuple[Column, Column, Column]]:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return {0: (safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp), tn + fp),
            1: (safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn), tp + fn)}


def weighted_metrics(conf: DataFrame) -> DataFrame:
    """Support-weighted precision, recall and F1; class-0 recall as specificity."""
    classes = _per_class(conf)
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")

    def weighted(values: list[Column]) -> Column:
        supports = [classes[c][2] for c in (0, 1)]
        return safe_ratio(values[0] * supports[0] + values[1] * supports[1], total)

    return conf.withColumns({
        "accuracy": safe_ratio(F.col("tp") + F.col("tn"), total),
        "precision_weighted": weighted([classes[c][0] for c in (0, 1)]),
        "recall_weighted": weighted([classes[c][1] for c in (0, 1)]),
        "specificity": classes[0][1],
        "f1_weighted": weighted([_f1(classes[c][0], classes[c][1]) for c in (0, 1)]),
    })


def confusion_matrix(conf: DataFrame) -> DataFrame:
    """Rows are the true classes: [[tn, fp], [fn, tp]]."""
    return conf.withColumn("confusion_matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp")))


def classification_report(conf: DataFrame) -> DataFrame:
    """Five rows: both classes, accuracy, macro and weighted averages."""
    classes = _per_class(conf)
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    acc = safe_ratio(F.col("tp") + F.col("tn"), total)
    stats = {c: (p, r, _f1(p, r), s) for c, (p, r, s) in classes.items()}
    macro = [(stats[0][i] + stats[1][i]) / 2.0 for i in range(3)]
    weighted = [safe_ratio(stats[0][i] * stats[0][3] + stats[1][i] * stats[1][3], total) for i in range(3)]

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("long").alias("support"))

    rows = [row("class_0", *stats[0]), row("class_1", *stats[1]), row("accuracy", acc, acc, acc, total),
            row("macro_avg", *macro, total), row("weighted_avg", *weighted, total)]
    return conf.select(F.inline(F.array(*rows)))


def accuracy_score(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def baseline_rate(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))


def train_test_gap(by_split: DataFrame) -> DataFrame:
    """Mean train-minus-test difference over six metrics, in points, judged."""
    def side(name):
        return [F.max(F.when(F.col("split") == name, F.col(m))) * 100 for m in SIX_METRICS]
    diffs = [a - b for a, b in zip(side("train"), side("test"))]
    gap = sum(diffs[1:], diffs[0]) / len(diffs)
    return by_split.agg(gap.alias("avg_gap")).withColumn(
        "verdict", F.when(F.col("avg_gap") < 1, "Excellent Generalization")
        .when(F.col("avg_gap") < 5, "Good Generalization").otherwise("Some Overfitting"))
