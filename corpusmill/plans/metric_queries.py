"""Metrics, curves and reports over a scored frame."""

from __future__ import annotations

import json
import math

from pyspark.sql import functions as F

from corpusmill.functions.numeric import log_loss_term, sigmoid, threshold_predict
from corpusmill.operators import curves as U
from corpusmill.operators import metrics as M
from corpusmill.operators import selection as L
from corpusmill.operators.profile import histogram
from corpusmill.operators.serving import align_predictions
from corpusmill.plans import inputs as I
from corpusmill.plans import sql as S
from corpusmill.plans.registry import query, rounded
from corpusmill.session import scratch_path
from corpusmill.sources import sinks as K

W = S.with_(*S.SCORED)
CONF = f"conf AS (SELECT {S.CONFUSION_COLUMNS} FROM scored)"
W_CONF = S.with_(*S.SCORED, CONF)


@query("threshold_predict", W + "SELECT doc_id, CAST(score >= 0.7 AS INTEGER) AS pred FROM scored")
def threshold(spark, sf):
    return I.scored(spark, sf).select("doc_id", threshold_predict(F.col("score"), 0.7).alias("pred"))


@query("confusion_counts", W_CONF + "SELECT tp, tn, fp, fn FROM conf")
def confusion_counts(spark, sf):
    return M.confusion_counts(I.scored(spark, sf))


@query("binary_metrics", W_CONF + f"SELECT tp, tn, fp, fn, {S.BINARY_COLUMNS} FROM conf")
def binary_metrics(spark, sf):
    return rounded(M.binary_metrics(M.confusion_counts(I.scored(spark, sf))))


@query("weighted_metrics", W_CONF + f"SELECT tp, tn, fp, fn, {S.WEIGHTED_COLUMNS} FROM conf")
def weighted_metrics(spark, sf):
    return rounded(M.weighted_metrics(M.confusion_counts(I.scored(spark, sf))))


@query("classification_report", W_CONF + S.report_rows("conf"))
def classification_report(spark, sf):
    return rounded(M.classification_report(M.confusion_counts(I.scored(spark, sf))))


@query("classification_report_text", W_CONF + "SELECT printf('%-14s %9.4f %9.4f %9.4f %9d', \"row\", \"precision\", recall, f1_score, support) AS value "
       f"FROM ({S.report_rows('conf')})")
def classification_report_text(spark, sf):
    path = scratch_path(spark, "report")
    report = M.classification_report(M.confusion_counts(I.scored(spark, sf)))
    K.text_report(K.report_lines(report), path)
    return spark.read.text(path)


@query("accuracy_score", W + "SELECT round(avg(CAST(label = pred AS DOUBLE)), 6) AS accuracy FROM scored")
def accuracy_score(spark, sf):
    return rounded(M.accuracy_score(I.scored(spark, sf)))


@query("baseline_rate", W + "SELECT round(avg(label), 6) AS positive_rate FROM scored")
def baseline_rate(spark, sf):
    return rounded(M.baseline_rate(I.scored(spark, sf)))


@query("auc_roc", S.with_(*S.SCORED, *S.auc("scored")) + "SELECT round(auc_roc, 6) AS auc_roc FROM auc_t")
def auc_roc(spark, sf):
    return rounded(U.auc_roc(I.scored(spark, sf)))


@query("auc_toxic", """WITH s AS (SELECT CAST(l.toxic AS INTEGER) AS label, d.n_chars AS score FROM documents d JOIN labels l USING (doc_id)),
""" + ",\n".join(S.auc("s")) + " SELECT round(auc_roc, 6) AS auc_roc FROM auc_t")
def auc_toxic(spark, sf):
    """Length as a score for the toxic label: many distinct scores."""
    labels = I.table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("int").alias("label"))
    docs = I.table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return rounded(U.auc_roc(docs.join(labels, "doc_id")))


RUN = """running AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg FROM (SELECT score, count(*) FILTER (label = 1) AS pos,
count(*) FILTER (label = 0) AS neg FROM scored GROUP BY score))"""
W_RUN = S.with_(*S.SCORED, RUN)


@query("average_precision", W_RUN + "SELECT round(sum(pos * (tp / (tp + fp)::DOUBLE)) / max(n_pos), 6) AS average_precision FROM running")
def average_precision(spark, sf):
    return rounded(U.average_precision(I.scored(spark, sf)))


@query("roc_curve", W_RUN + """SELECT round(score, 6) AS threshold, round(tp / n_pos::DOUBLE, 6) AS tpr, round(fp / n_neg::DOUBLE, 6) AS fpr
FROM running UNION ALL SELECT NULL, 0, 0""")
def roc_curve(spark, sf):
    return rounded(U.roc_curve(I.scored(spark, sf)))


@query("pr_curve", W_RUN + """SELECT round(score, 6) AS threshold, round(tp / (tp + fp)::DOUBLE, 6) AS "precision",
round(tp / n_pos::DOUBLE, 6) AS recall FROM running""")
def pr_curve(spark, sf):
    return rounded(U.pr_curve(I.scored(spark, sf)))


@query("curve_areas", S.with_(*S.SCORED, RUN, *S.auc("scored")) + """SELECT round((SELECT auc_roc FROM auc_t), 6) AS auc_roc,
round(sum(pos * (tp / (tp + fp)::DOUBLE)) / max(n_pos), 6) AS average_precision, count(*) + 1 AS n_roc, count(*) AS n_pr,
round(max(tp / n_pos::DOUBLE - fp / n_neg::DOUBLE), 6) AS widest_gap FROM running""")
def curve_areas(spark, sf):
    """Both areas and both curves from one written table of scores."""
    table = U.ScoreTable.of(I.scored(spark, sf))
    roc = U.roc_curve(table).agg(F.count("*").alias("n_roc"), F.max(F.when(F.col("threshold").isNotNull(), F.col("tpr") - F.col("fpr"))).alias("widest_gap"))
    pr = U.pr_curve(table).agg(F.count("*").alias("n_pr"))
    areas = U.auc_roc(table).withColumn("average_precision", U.average_precision(table).scalar())
    return rounded(areas.withColumns({"n_roc": roc.select("n_roc").scalar(), "n_pr": pr.scalar(), "widest_gap": roc.select("widest_gap").scalar()}))


SWEEP = """levels AS (SELECT CAST(k AS INTEGER) AS step, CASE WHEN k = 99 THEN 0.0::DOUBLE ELSE k * (-1.0::DOUBLE / 99) + 1.0::DOUBLE END AS threshold
FROM range(100) t(k)),
hits AS (SELECT step, threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp, count(*) FILTER (label = 0 AND score >= threshold) AS fp,
count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM levels, scored GROUP BY step, threshold),
sweep AS (SELECT step, threshold, tp / p::DOUBLE AS tpr, fp / n::DOUBLE AS fpr, CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp)::DOUBLE END AS prec,
tp / p::DOUBLE AS recall FROM hits)"""
W_SWEEP = S.with_(*S.SCORED, SWEEP)


@query("threshold_sweep", W_SWEEP + """SELECT step, round(threshold, 6) AS threshold, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr,
round(prec, 6) AS "precision", round(recall, 6) AS recall FROM sweep""")
def threshold_sweep(spark, sf):
    return rounded(U.threshold_sweep(I.scored(spark, sf)))


@query("sweep_auc", W_SWEEP + """SELECT round(sum(area), 6) AS sweep_auc, round(avg(prec), 6) AS mean_precision_100 FROM
(SELECT prec, (fpr - lag(fpr) OVER (ORDER BY step)) * (tpr + lag(tpr) OVER (ORDER BY step)) / 2 AS area FROM sweep)""")
def sweep_auc(spark, sf):
    return rounded(U.sweep_auc(U.threshold_sweep(I.scored(spark, sf))))


@query("running_metrics", S.with_(*S.SCORED, f"""b AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch FROM scored),
c AS (SELECT batch, {S.CONFUSION_COLUMNS} FROM b GROUP BY batch),
r AS (SELECT batch, CAST(sum(tp) OVER w AS BIGINT) AS tp, CAST(sum(tn) OVER w AS BIGINT) AS tn, CAST(sum(fp) OVER w AS BIGINT) AS fp,
CAST(sum(fn) OVER w AS BIGINT) AS fn FROM c WINDOW w AS (ORDER BY batch))""") + f"SELECT batch, tp, tn, fp, fn, {S.BINARY_COLUMNS} FROM r")
def running_metrics(spark, sf):
    return rounded(U.running_metrics(I.scored(spark, sf), batch_size=50))


@query("score_histogram", W + "SELECT bin, coalesce(n, 0) AS n FROM (SELECT range AS bin FROM range(1, 21)) LEFT JOIN (" + "SELECT bin, count(*) AS n FROM (SELECT CAST(least(floor((score - lo) / (hi - lo) * 20) + 1, 20) AS BIGINT) AS bin "
       "FROM (SELECT score, min(score) OVER () AS lo, max(score) OVER () AS hi FROM scored)) GROUP BY bin) USING (bin)")
def score_histogram(spark, sf):
    return histogram(I.scored(spark, sf), "score", 20)


SPLIT_SCORED = [*S.SCORED, *S.split("scored", "ssplit")]
SPLIT_CONF = f"sconf AS (SELECT split, {S.CONFUSION_COLUMNS} FROM ssplit GROUP BY split)"


def _split_scored(spark, sf):
    from corpusmill.operators.split import stratified_split
    return stratified_split(I.scored(spark, sf))


@query("evaluate_splits", S.with_(*SPLIT_SCORED, SPLIT_CONF, *S.auc("ssplit", "split")) +
       f"SELECT c.split, tp, tn, fp, fn, {S.BINARY_COLUMNS}, round(auc_roc, 6) AS auc_roc FROM sconf c JOIN auc_t a ON a.split = c.split")
def evaluate_splits(spark, sf):
    return rounded(L.evaluate_splits(_split_scored(spark, sf)))


def _gap_sql():
    cols = {"accuracy": "(tp + tn) / (tp + tn + fp + fn)::DOUBLE", "precision": "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)",
            "recall": "coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)", "specificity": "coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0)",
            "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)"}
    total = f"({cols['accuracy']} + {cols['precision']} + 2 * {cols['recall']} + {cols['specificity']} + {cols['f1']}) * 100 / 6"
    return (S.with_(*SPLIT_SCORED, SPLIT_CONF, f"m AS (SELECT split, {total} AS mean FROM sconf)",
                    "g AS (SELECT max(mean) FILTER (split = 'train') - max(mean) FILTER (split = 'test') AS gap FROM m)")
            + "SELECT round(gap, 6) AS avg_gap, CASE WHEN gap < 1 THEN 'Excellent Generalization' WHEN gap < 5 THEN 'Good Generalization' "
              "ELSE 'Some Overfitting' END AS verdict FROM g")


@query("train_test_gap", _gap_sql())
def train_test_gap(spark, sf):
    by_split = M.binary_metrics(M.confusion_counts(_split_scored(spark, sf), "split"))
    return rounded(M.train_test_gap(by_split))


@query("sigmoid", S.with_(*S.SCORED) + "SELECT doc_id, round(1 / (1 + exp(-greatest(-500, least(500, (score - 0.5::DOUBLE) * 2000)))), 6) AS p FROM scored")
def sigmoids(spark, sf):
    return rounded(I.scored(spark, sf).select("doc_id", sigmoid((F.col("score") - F.lit(0.5)) * 2000).alias("p")))


PENALISED = S.with_(*S.SCORED) + """SELECT round((SELECT avg(CASE WHEN label = 1 THEN -ln(p) ELSE -ln(1 - p) END) FROM
(SELECT label, least(greatest(score, 1e-15::DOUBLE), 1 - 1e-15::DOUBLE) AS p FROM scored))
+ 0.5::DOUBLE / (2 * (SELECT count(*) FROM scored)) * (SELECT sum((n_nationkey / 10.0::DOUBLE) ** 2) FROM nation), 6) AS cost"""


@query("log_loss_penalised", PENALISED)
def log_loss_penalised(spark, sf):
    """Cross-entropy of the scored frame plus the penalty of a weight table."""
    from corpusmill.operators.linear import log_loss as penalised
    weights = I.table(spark, sf, "nation").select((F.col("n_nationkey") / 10.0).alias("w"))
    return rounded(penalised(I.scored(spark, sf), weights, 0.5))


@query("load_linear_config", f"SELECT cost, 0.25::DOUBLE AS learning_rate, CAST(1500 AS INTEGER) AS n_iterations, CAST(6 AS INTEGER) AS n_settings FROM ({PENALISED})")
def load_linear_config(spark, sf):
    """Descent settings from a written file set the penalty; what the file leaves out keeps its default."""
    from corpusmill.config import linear_config_from_json
    from corpusmill.operators.linear import log_loss as penalised
    path = scratch_path(spark, "settings")
    written = {"hyperparameters": {"learning_rate": 0.25, "regularization": 0.5, "unknown": 1},
               "hyperparameter_search_space": {"learning_rate": [0.1, 0.2, 0.3], "regularization": [0.5, 1.0]}}
    K.text_report(spark.createDataFrame([(json.dumps(written),)], "value string"), path)
    config = linear_config_from_json(spark.read.text(path).first().value)
    weights = I.table(spark, sf, "nation").select((F.col("n_nationkey") / 10.0).alias("w"))
    return rounded(penalised(I.scored(spark, sf), weights, config.regularization).withColumns({
        "learning_rate": F.lit(config.learning_rate), "n_iterations": F.lit(config.n_iterations),
        "n_settings": F.lit(math.prod(len(v) for v in config.search_space.values()))}))


@query("log_loss", W + """SELECT round(avg(CASE WHEN label = 1 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS cost FROM
(SELECT label, greatest(1e-15::DOUBLE, least(1 - 1e-15::DOUBLE, score)) AS p FROM scored)""")
def log_loss(spark, sf):
    return rounded(I.scored(spark, sf).agg(F.avg(log_loss_term(F.col("label"), F.col("score"))).alias("cost")))


REPORT = """SELECT s.doc_id, l.title, CASE WHEN length(l.text) > 200 THEN substr(l.text, 1, 200) || '...' ELSE l.text END AS text,
l.label AS true_label, pred AS predicted_label, CASE WHEN l.label = 1 THEN 'Real News' ELSE 'Fake News' END AS true_class,
CASE WHEN pred = 1 THEN 'Real News' ELSE 'Fake News' END AS predicted_class, l.label = pred AS correct
FROM scored s JOIN labelled l USING (doc_id)"""


@query("align_predictions", W + REPORT)
def align(spark, sf):
    return align_predictions(I.labelled(spark, sf), I.scored(spark, sf))


@query("write_predictions", W + REPORT)
def write_predictions(spark, sf):
    report = align_predictions(I.labelled(spark, sf), I.scored(spark, sf))
    path = scratch_path(spark, "predictions")
    K.write_predictions(report, path)
    back = spark.read.options(header=True, multiLine=True, escape='"').schema(report.schema).csv(path)
    return back.fillna("", subset=["title", "text"])     # CSV does not tell an empty cell from a missing one


@query("write_metrics", W_CONF + f"SELECT 'ttr' AS test_name, tp, tn, fp, fn, {S.WEIGHTED_COLUMNS}, [[tn, fp], [fn, tp]]::VARCHAR AS confusion_matrix FROM conf")
def write_metrics(spark, sf):
    table = rounded(M.confusion_matrix(M.weighted_metrics(M.confusion_counts(I.scored(spark, sf)))))
    path = scratch_path(spark, "metrics")
    K.write_metrics(table, path, test_name="ttr")
    back = spark.read.schema(table.schema.add("test_name", "string")).json(path)
    inner = F.transform("confusion_matrix", lambda r: F.concat(F.lit("["), F.array_join(r.cast("array<string>"), ", "), F.lit("]")))
    return back.withColumn("confusion_matrix", F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]")))


@query("specificity_evaluator", W_CONF + "SELECT round(tn / (tn + fp)::DOUBLE, 6) AS specificity FROM conf")
def specificity_evaluator(spark, sf):
    frame = I.scored(spark, sf).withColumn("prediction", F.col("pred").cast("double"))
    value = L.SpecificityEvaluator().evaluate(frame)
    return rounded(spark.range(1).select(F.lit(value).alias("specificity")))
