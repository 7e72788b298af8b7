"""Naive Bayes: fitting, cross-validation, selection, external scoring."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from corpusmill.config import FeatureConfig
from corpusmill.operators import naive_bayes as N
from corpusmill.operators import selection as L
from corpusmill.operators import serving as H
from corpusmill.operators import split as Y
from corpusmill.operators import tfidf as V
from corpusmill.operators.curves import auc_roc
from corpusmill.operators.metrics import confusion_counts, weighted_metrics
from corpusmill.plans import inputs as I
from corpusmill.plans import sql as S
from corpusmill.plans.registry import query, rounded
from corpusmill.session import materialize

CONFIG = FeatureConfig()
CAP = CONFIG.max_features
ALPHAS = [0.1, 0.5, 1.0, 2.0, 5.0]
TRAINED = [*S.TRAIN_FEATURES, *S.TEST_FEATURES, *S.NB_SUMS]
SCORES = "SELECT doc_id, label, round(margin, 6) AS margin, round(score, 6) AS score, pred FROM nb_scored"


class _Fit:
    """Training and test weights under the training vocabulary, written once."""

    def __init__(self, spark, sf):
        s = I.sides(spark, sf)
        self.train, self.test = s.train, s.test
        self.vocab = materialize(V.fit_vocabulary(s.train), "vocab")
        weights = materialize(V.tfidf_transform(s.all, self.vocab, CONFIG, "label", "split"), "weights")
        self.train_weights = weights.where(F.col("split") == "train")
        self.test_weights = weights.where(F.col("split") == "test")


def _predict(spark, sf, kind, alpha):
    f = _Fit(spark, sf)
    scorer = N.fit_nb(f.train_weights, f.train, f.vocab, kind, alpha)
    return rounded(N.predict_nb(f.test, f.test_weights, scorer, CAP, "label").select("doc_id", "label", "margin", "score", "pred"))


def _nb_sql(kind, alpha):
    return S.with_(*TRAINED, *S.nb_model(kind, alpha), *S.nb_scores(kind, "test", "test_tfidf"))


@query("nb_multinomial", _nb_sql("MNB", 0.1) + SCORES)
def nb_multinomial(spark, sf):
    return _predict(spark, sf, "MNB", 0.1)


@query("nb_bernoulli", _nb_sql("BNB", 0.1) + SCORES)
def nb_bernoulli(spark, sf):
    return _predict(spark, sf, "BNB", 0.1)


@query("nb_complement", _nb_sql("CNB", 0.1) + SCORES)
def nb_complement(spark, sf):
    return _predict(spark, sf, "CNB", 0.1)


@query("predict_with_params", S.with_(*TRAINED, *S.nb_model("MNB", 2.0), *S.nb_scores("MNB", "test", "test_tfidf")) + SCORES)
def predict_with_params(spark, sf):
    """Two settings from the same stored sums; the texts are read once."""
    f = _Fit(spark, sf)
    sums = materialize(N.label_term_sums(f.train_weights), "sums")
    scorer = H.scorer_for(sums, f.train, f.vocab, "MNB", 2.0)
    return rounded(N.predict_nb(f.test, f.test_weights, scorer, CAP, "label").select("doc_id", "label", "margin", "score", "pred"))


# --- cross-validation ---------------------------------------------------------

def _cv_sql(alphas=ALPHAS):
    """Sums, weights and scores per held-out fold; kinds and alphas unrolled."""
    grid = [(k, a) for k in N.KINDS for a in alphas]
    ctes = [*S.CORPUS, *S.split(), S.folds("train", "ftrain"), *S.postings("train", extra=", label"), *S.vocab("train"),
            *S.tfidf(extra=", label"),
            "fw AS (SELECT t.*, f.fold FROM tfidf t JOIN ftrain f USING (doc_id))",
            "held AS (SELECT unnest([0, 1, 2, 3, 4]) AS held)",
            "sums AS (SELECT h.held, w.term_idx, coalesce(sum(weight) FILTER (label = 0 AND fold <> held), 0)::DOUBLE AS f0, "
            "coalesce(sum(weight) FILTER (label = 1 AND fold <> held), 0)::DOUBLE AS f1, "
            "count(*) FILTER (label = 0 AND fold <> held) AS d0, count(*) FILTER (label = 1 AND fold <> held) AS d1 "
            "FROM fw w, held h GROUP BY h.held, w.term_idx)",
            "sizes AS (SELECT h.held, count(*) FILTER (label = 0 AND fold <> held) AS n0, count(*) FILTER (label = 1 AND fold <> held) AS n1 "
            "FROM ftrain, held h GROUP BY h.held)",
            "nfull AS (SELECT s.*, z.n0, z.n1, sum(f0) OVER (PARTITION BY s.held) AS t0, sum(f1) OVER (PARTITION BY s.held) AS t1, "
            "count(*) OVER (PARTITION BY s.held) AS v FROM sums s JOIN sizes z ON z.held = s.held)",
            "params AS (" + " UNION ALL ".join(
                f"SELECT held, term_idx, '{k}' AS kind, {a}::DOUBLE AS alpha, {S.nb_weight(k, f'{a}::DOUBLE')} AS w FROM nfull" for k, a in grid) + ")",
            "biases AS (" + " UNION ALL ".join(
                f"SELECT held, '{k}' AS kind, {a}::DOUBLE AS alpha, sum({S.nb_absent(k, f'{a}::DOUBLE')}) + max({S.nb_prior(k)}) AS b FROM nfull GROUP BY held"
                for k, a in grid) + ")",
            "dots AS (SELECT w.doc_id, kind, alpha, sum(CASE WHEN kind = 'BNB' THEN 1.0::DOUBLE ELSE weight END * p.w) AS dot "
            "FROM fw w JOIN params p ON p.held = w.fold AND p.term_idx = w.term_idx GROUP BY ALL)",
            "cvs AS (SELECT f.doc_id, f.fold, f.label, b.kind, b.alpha, coalesce(d.dot, 0) + b.b AS score, "
            "CAST(coalesce(d.dot, 0) + b.b > 0 AS INTEGER) AS pred FROM ftrain f JOIN biases b ON b.held = f.fold "
            "LEFT JOIN dots d ON d.doc_id = f.doc_id AND d.kind = b.kind AND d.alpha = b.alpha)",
            f"cvc AS (SELECT kind, alpha, fold, {S.CONFUSION_COLUMNS} FROM cvs GROUP BY kind, alpha, fold)",
            *S.auc("cvs", "kind, alpha, fold"),
            "cvw AS (SELECT c.*, " + ", ".join(f"{e} AS {n}" for n, e in S.WEIGHTED.items()) + ", auc_roc FROM cvc c JOIN auc_t USING (kind, alpha, fold))"]
    names = {"accuracy": "accuracy", "precision": "precision_weighted", "sensitivity": "recall_weighted",
             "specificity": "specificity", "f1": "f1_weighted", "auc": "auc_roc"}
    ctes.append("cv AS (" + " UNION ALL ".join(
        f"SELECT kind, alpha, fold, '{m}' AS metric, {c} AS value FROM cvw" for m, c in names.items()) + ")")
    return ctes


CV = _cv_sql()
BEST = """best AS (SELECT kind, alpha, mean, row_number() OVER (ORDER BY mean DESC, kind) AS family_rank FROM
(SELECT kind, alpha, round(avg(value), 12) AS mean FROM cv WHERE metric = 'accuracy' GROUP BY kind, alpha
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round(avg(value), 12) DESC, alpha) = 1))"""


def _cv_table(spark, sf):
    train = materialize(Y.stratified_folds(I.sides(spark, sf).train), "folds")
    vocab = materialize(V.fit_vocabulary(train), "vocab")
    weights = materialize(V.tfidf_transform(train, vocab, CONFIG, "label", "fold"), "weights")
    return L.cv_grid(train, weights, ALPHAS, max_features=CAP)


@query("cv_grid_multi_metric", S.with_(*CV) + "SELECT kind, alpha, fold, metric, round(value, 6) AS value FROM cv")
def cv_grid(spark, sf):
    return rounded(_cv_table(spark, sf))


@query("best_of_family", S.with_(*CV, BEST) + "SELECT kind, alpha, round(mean, 6) AS mean, CAST(family_rank AS INTEGER) AS family_rank FROM best")
def best_of_family(spark, sf):
    return rounded(L.best_of_family(_cv_table(spark, sf)))


@query("metric_vs_alpha", S.with_(*CV) + "SELECT kind, alpha, " + ", ".join(
    f"round(avg(value) FILTER (metric = '{m}'), 6) AS {m}" for m in L.CV_METRICS) + " FROM cv GROUP BY kind, alpha")
def metric_vs_alpha(spark, sf):
    return rounded(L.metric_vs_alpha(_cv_table(spark, sf)))


@query("cv_summary", S.with_(*CV, BEST) + """SELECT kind, alpha, round(avg(value), 6) AS mean_score, round(stddev_pop(value), 6) AS std_score,
count(*) AS n_folds FROM cv JOIN (SELECT kind, alpha FROM best WHERE family_rank = 1) USING (kind, alpha) WHERE metric = 'accuracy' GROUP BY kind, alpha""")
def cv_summary(spark, sf):
    return rounded(L.cv_summary(_cv_table(spark, sf)))


@query("param_effect", S.with_(*CV) + """SELECT alpha, round(avg(value), 6) AS mean_score, round(stddev_samp(value), 6) AS std_score
FROM cv WHERE metric = 'f1' GROUP BY alpha""")
def param_effect(spark, sf):
    return rounded(L.param_effect(_cv_table(spark, sf).where("metric = 'f1'"), "alpha", "value"))


@query("param_pivot", S.with_(*CV) + "SELECT alpha, " + ", ".join(
    f"round(avg(value) FILTER (kind = '{k}'), 6) AS {k}" for k in N.KINDS) + " FROM cv WHERE metric = 'f1' GROUP BY alpha")
def param_pivot(spark, sf):
    return rounded(L.param_pivot(_cv_table(spark, sf).where("metric = 'f1'"), "alpha", "kind", list(N.KINDS), "value"))


@query("top_configs", S.with_(*CV) + """SELECT kind, alpha, round(mean, 6) AS mean FROM (SELECT kind, alpha, round(avg(value), 12) AS mean
FROM cv WHERE metric = 'accuracy' GROUP BY kind, alpha) ORDER BY mean DESC, kind, alpha LIMIT 10""")
def top_configs(spark, sf):
    means = L.cv_means(_cv_table(spark, sf)).where("metric = 'accuracy'").select(
        "kind", "alpha", F.round("mean", 12).alias("mean"))
    return rounded(L.top_configs(means, 10, "mean", "kind", "alpha"))


PARTS, FOLDS = 10, 5


def _curve_sql(alpha=0.1):
    a = f"{alpha}::DOUBLE"
    inside = "fold <> held AND part <= size"
    return S.with_(
        *S.CORPUS, *S.split(), S.folds("train", "ft"), S.folds("ft", "ftrain", k=PARTS, seed=7, column="part", base=1),
        *S.postings("train", extra=", label"), *S.vocab("train"), *S.tfidf(extra=", label"),
        "fw AS (SELECT t.*, f.fold, f.part FROM tfidf t JOIN ftrain f USING (doc_id))",
        "grid AS (SELECT held, size FROM range(5) a(held), range(1, 11) b(size))",
        f"sums AS (SELECT held, size, term_idx, count(*) FILTER (label = 0 AND {inside}) AS d0, count(*) FILTER (label = 1 AND {inside}) AS d1 "
        "FROM fw, grid GROUP BY ALL)",
        f"sizes AS (SELECT held, size, count(*) FILTER (label = 0 AND {inside}) AS n0, count(*) FILTER (label = 1 AND {inside}) AS n1 FROM ftrain, grid GROUP BY ALL)",
        f"p AS (SELECT s.held, s.size, term_idx, {S.nb_weight('BNB', a)} AS w, {S.nb_absent('BNB', a)} AS absent, n0, n1 FROM sums s JOIN sizes z ON z.held = s.held AND z.size = s.size)",
        "b AS (SELECT held, size, sum(absent) + max(CASE WHEN n1 = 0 THEN '-inf'::DOUBLE WHEN n0 = 0 THEN 'inf'::DOUBLE ELSE ln(n1 / n0::DOUBLE) END) AS b FROM p GROUP BY held, size)",
        "dots AS (SELECT fw.doc_id, held, size, sum(w) AS dot FROM fw JOIN p USING (term_idx) GROUP BY ALL)",
        "hits AS (SELECT f.fold, f.part, b.held, b.size, CAST(CAST(coalesce(dot, 0) + b.b > 0 AS INTEGER) = f.label AS DOUBLE) AS hit FROM ftrain f CROSS JOIN b "
        "LEFT JOIN dots d ON d.doc_id = f.doc_id AND d.held = b.held AND d.size = b.size)",
        f"per AS (SELECT size, held, avg(hit) FILTER ({inside}) AS train, avg(hit) FILTER (fold = held) AS test FROM hits GROUP BY ALL)",
    ) + ("SELECT CAST(size AS INTEGER) AS size, round(avg(train), 6) AS train_mean, round(stddev_pop(train), 6) AS train_std, round(avg(test), 6) AS cv_mean, "
         "round(stddev_pop(test), 6) AS cv_std FROM per GROUP BY size")


@query("learning_curve", _curve_sql())
def learning_curve(spark, sf):
    train = materialize(Y.nested_tenths(materialize(Y.stratified_folds(I.sides(spark, sf).train), "folds")), "parts")
    vocab = materialize(V.fit_vocabulary(train), "vocab")
    weights = materialize(V.tfidf_transform(train, vocab, CONFIG, "label", "fold", "part"), "weights")
    return rounded(L.learning_curve_nb(train, weights, vocab, "BNB", 0.1, PARTS, FOLDS, CAP))


# --- external corpus ----------------------------------------------------------

EXTERNAL = [S.ARTICLES, S.LABELLED, S.cleaned(),
            S.dedup(f"(SELECT * FROM cleaned WHERE subject NOT IN ({S.OUTSIDE}))", "train"),
            f"outside AS (SELECT * FROM cleaned WHERE subject IN ({S.OUTSIDE}))",
            *S.postings("train", extra=", label"), *S.vocab("train"), *S.tfidf(extra=", label"), *S.NB_SUMS,
            *S.postings("outside", "x_", extra=", label"), *S.tfidf("x_posts", "vocab", "x_tfidf", ", label"),
            *S.nb_model("BNB", 0.1), *S.nb_scores("BNB", "outside", "x_tfidf")]


def _external_fit(spark, sf):
    from corpusmill.operators.corpus import prepare_corpus
    docs = I.labelled(spark, sf)
    train = materialize(prepare_corpus(I.in_domain(docs)), "prepared")
    fitted = V.FittedFeatures(CONFIG, materialize(V.fit_vocabulary(train), "vocab"))
    weights = fitted.transform(train, "label")
    scorer = N.fit_nb(weights, train, fitted.vocab, "BNB", 0.1)
    return fitted, scorer, I.external(docs)


@query("external_eval", S.with_(*EXTERNAL, f"conf AS (SELECT {S.CONFUSION_COLUMNS} FROM nb_scored)",
       "margins AS (SELECT label, margin AS score FROM nb_scored)", *S.auc("margins"))
       + f"SELECT tp, tn, fp, fn, {S.WEIGHTED_COLUMNS}, round(auc_roc, 6) AS auc_roc FROM conf, auc_t")
def external_eval(spark, sf):
    """Fitted on the in-domain sources, applied to the others without refitting."""
    fitted, scorer, outside = _external_fit(spark, sf)
    scored = materialize(H.predict_batch(outside, fitted, scorer), "predicted")
    area = auc_roc(scored.withColumn("score", F.col("margin")))
    return rounded(weighted_metrics(confusion_counts(scored)).withColumn("auc_roc", area.scalar()))


@query("predict_table", S.with_(*EXTERNAL) + """SELECT doc_id, label, pred, CASE WHEN pred = 1 THEN 'Real News' ELSE 'Fake News' END AS pred_class,
round(score, 6) AS real_probability FROM nb_scored""")
def predict_table(spark, sf):
    fitted, scorer, outside = _external_fit(spark, sf)
    predicted, _ = H.predict_table(outside, fitted, scorer)
    return rounded(predicted.select("doc_id", "label", "pred", "pred_class", "real_probability"))


@query("predict_batch", S.with_(*EXTERNAL) + """SELECT doc_id, pred, round(score, 6) AS real_probability,
round(1 - score, 6) AS fake_probability FROM nb_scored""")
def predict_batch(spark, sf):
    fitted, scorer, outside = _external_fit(spark, sf)
    out = H.predict_batch(outside.drop("label"), fitted, scorer)
    return rounded(out.select("doc_id", "pred", "real_probability", "fake_probability"))


@query("transform_records", S.with_(*EXTERNAL) + "SELECT doc_id, term, term_idx, round(weight, 6) AS weight FROM x_tfidf")
def transform_records(spark, sf):
    docs = I.labelled(spark, sf)
    from corpusmill.operators.corpus import prepare_corpus
    fitted = V.FittedFeatures(CONFIG, V.fit_vocabulary(prepare_corpus(I.in_domain(docs))))
    return rounded(H.transform_records(I.external(docs), fitted).select("doc_id", "term", "term_idx", "weight"))


SUBJECTS = [S.ARTICLES, S.LABELLED, f"cleaned AS (SELECT doc_id, label, subject AS origin, lang AS subject, {S.clean(S.CONTENT)} AS content FROM labelled)",
            S.dedup(f"(SELECT * FROM cleaned WHERE origin NOT IN ({S.OUTSIDE}))", "train", "content, subject"),
            f"outside AS (SELECT * FROM cleaned WHERE origin IN ({S.OUTSIDE}))",
            *S.postings("train", extra=", label"), *S.vocab("train"), *S.tfidf(extra=", label"),
            *S.postings("outside", "x_", extra=", label"), *S.tfidf("x_posts", "vocab", "x_tfidf", ", label"),
            "names AS (SELECT subject, CAST(row_number() OVER (ORDER BY subject) - 1 + (SELECT count(*) FROM vocab) AS INTEGER) AS term_idx FROM (SELECT DISTINCT subject FROM train))",
            "rows AS (SELECT doc_id, term_idx, weight FROM x_tfidf UNION ALL SELECT doc_id, term_idx, 1.0::DOUBLE FROM outside JOIN names USING (subject))",
            "sums AS (SELECT term_idx, sum(weight) / (SELECT count(*) FROM train) AS s, sum(weight * weight) / (SELECT count(*) FROM train) AS q FROM "
            "(SELECT term_idx, weight FROM tfidf UNION ALL SELECT term_idx, 1.0::DOUBLE FROM train JOIN names USING (subject)) GROUP BY term_idx)",
            "scales AS (SELECT term_idx, CASE WHEN q - s * s > 1e-15::DOUBLE * greatest(q, 1e-300::DOUBLE) THEN sqrt(q - s * s) ELSE 1 END AS scale FROM sums)"]


def _subject_records(spark, sf, scaled):
    """The language stands in for the subject: training has seen all of them."""
    from corpusmill.operators.corpus import prepare_corpus
    config = replace(CONFIG, include_subject=True, produce_scaled=True)
    docs = I.labelled(spark, sf)
    train = materialize(prepare_corpus(I.in_domain(docs).withColumn("subject", F.col("lang")), config), "prepared")
    fitted = V.FittedFeatures(config, materialize(V.fit_vocabulary(train, config), "vocab"), None, materialize(V.fit_subjects(train), "subjects"))
    if scaled:
        fitted.scale = V.fit_scale(fitted.transform(train), train.count())
    records = I.external(docs).withColumn("subject", F.col("lang"))
    return rounded(H.transform_records(records, fitted, scaled).select("doc_id", "term_idx", "weight"))


@query("transform_records_subject", S.with_(*SUBJECTS) + "SELECT doc_id, term_idx, round(weight, 6) AS weight FROM rows")
def transform_records_subject(spark, sf):
    return _subject_records(spark, sf, False)


@query("transform_records_scaled", S.with_(*SUBJECTS) + "SELECT doc_id, term_idx, round(weight / coalesce(scale, 1), 6) AS weight FROM rows LEFT JOIN scales USING (term_idx)")
def transform_records_scaled(spark, sf):
    return _subject_records(spark, sf, True)


@query("predict_one", S.with_(*EXTERNAL) + "SELECT doc_id, pred, round(score, 6) AS real_probability FROM nb_scored ORDER BY doc_id LIMIT 1")
def predict_one(spark, sf):
    """One article: the first of the external corpus."""
    fitted, scorer, outside = _external_fit(spark, sf)
    first = outside.orderBy("doc_id").select("doc_id", "title", "text").first()
    out = H.predict_one(spark, first.title, first.text, fitted, scorer)
    return rounded(out.select(F.lit(first.doc_id).cast("long").alias("doc_id"), "pred", "real_probability"))
