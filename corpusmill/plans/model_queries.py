"""Linear models, kernel map, trees, tuning, persistence, streams, protection."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession, Window, functions as F

from corpusmill.config import SVM_CONFIGS, TREE_SPACE, FeatureConfig, LinearConfig
from corpusmill.operators import kernel as R
from corpusmill.operators import linear as G
from corpusmill.operators import naive_bayes as N
from corpusmill.operators import protect as Q
from corpusmill.operators import selection as L
from corpusmill.operators import split as Y
from corpusmill.operators import terms as X
from corpusmill.operators import textmodel as T
from corpusmill.operators import tfidf as V
from corpusmill.operators import trees as D
from corpusmill.operators.curves import auc_roc
from corpusmill.operators.metrics import binary_metrics, confusion_counts, weighted_metrics
from corpusmill.operators.vectors import vector_frame
from corpusmill.plans import inputs as I
from corpusmill.plans import sql as S
from corpusmill.plans.bayes_queries import EXTERNAL, _external_fit
from corpusmill.plans.registry import query, rounded
from corpusmill.session import materialize, scratch_path
from corpusmill.sources import models as Z
from corpusmill.streaming import scoring as W

CONFIG = FeatureConfig()
CAP = CONFIG.max_features


class _Rows:
    """Train and test rows under the training vocabulary, from written tables."""

    def __init__(self, spark, sf, scaled=False):
        s = I.sides(spark, sf)
        self.docs, self.train, self.test = s.all, s.train, s.test
        self.vocab = materialize(V.fit_vocabulary(s.train), "vocab")
        self.size = self.vocab.count()
        self.n_train = s.train.count()
        weights = V.tfidf_transform(s.all, self.vocab, CONFIG, "label", "split")
        if scaled:
            weights = materialize(weights, "unscaled")
            scale = V.fit_scale(weights.where(F.col("split") == "train"), self.n_train)
            weights = V.apply_scale(weights, scale, CAP).select("doc_id", "label", "split", "term", "term_idx", "tf", "weight")
        self.weights = materialize(weights, "weights")
        self.rows = materialize(V.sparse_rows(s.all, self.weights, "label", "split"), "rows")

    def side(self, name):
        return self.rows.where(F.col("split") == name).drop("split")

    def vectors(self):
        return vector_frame(self.rows, self.size)


# --- gradient descent -----------------------------------------------------------

STEPS, RATE, REG = 2, 0.05, 0.001


def _descent_sql():
    """Two unrolled steps from zero weights on the unscaled training postings."""
    ctes = [*S.TRAIN_FEATURES, "m AS (SELECT count(*)::DOUBLE AS m FROM train)",
            "w0 AS (SELECT term_idx, 0.0::DOUBLE AS w FROM vocab)", "b0 AS (SELECT 0.0::DOUBLE AS b)"]
    for i in range(STEPS):
        ctes += [
            f"z{i} AS (SELECT d.doc_id, d.label, 1 / (1 + exp(-(coalesce(sum(t.weight * w.w), 0) + max(b.b)))) - d.label AS diff "
            f"FROM train d LEFT JOIN tfidf t USING (doc_id) LEFT JOIN w{i} w USING (term_idx), b{i} b GROUP BY d.doc_id, d.label)",
            f"g{i} AS (SELECT term_idx, sum(weight * diff) AS g FROM tfidf JOIN z{i} USING (doc_id) GROUP BY term_idx)",
            f"w{i + 1} AS (SELECT w.term_idx, w.w - {RATE}::DOUBLE * (coalesce(g, 0) / m + {REG}::DOUBLE / m * w.w) AS w "
            f"FROM w{i} w LEFT JOIN g{i} USING (term_idx), m)",
            f"b{i + 1} AS (SELECT b.b - {RATE}::DOUBLE * (SELECT sum(diff) FROM z{i}) / m AS b FROM b{i} b, m)"]
    return ctes


def _descend(spark, sf):
    r = _Rows(spark, sf)
    return r, G.logreg_gd(r.side("train"), r.size, RATE, STEPS, REG)


@query("logreg_gd", S.with_(*_descent_sql()) + f"SELECT term_idx, round(w * 1000, 6) AS w FROM w{STEPS} UNION ALL SELECT -1, round(b * 1000, 6) FROM b{STEPS}")
def logreg_gd(spark, sf):
    """Weights after two steps, in thousandths; the bias has index -1."""
    _, model = _descend(spark, sf)
    frame = model.weight_frame(spark).unionByName(
        spark.range(1).select(F.lit(-1).alias("term_idx"), F.lit(float(model.bias)).alias("w")))
    return rounded(frame.select("term_idx", (F.col("w") * 1000).alias("w")))


@query("cost_history", S.with_(*_descent_sql(), f"""p AS (SELECT d.doc_id, d.label, 1 / (1 + exp(-(coalesce(sum(t.weight * w.w), 0) + max(b.b)))) AS p
FROM train d LEFT JOIN tfidf t USING (doc_id) LEFT JOIN w1 w USING (term_idx), b1 b GROUP BY d.doc_id, d.label)""")
       + f"SELECT 0 AS iteration, round(avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) + {REG}::DOUBLE / (2 * count(*)) * (SELECT sum(w * w) FROM w1), 6) AS cost FROM p")
def cost_history(spark, sf):
    _, model = _descend(spark, sf)
    return rounded(model.cost_history(spark))


@query("linear_score", S.with_(*_descent_sql(), *S.TEST_FEATURES) + f"""SELECT d.doc_id, round(coalesce(sum(weight * w), 0) + max(b), 6) AS margin,
round(1 / (1 + exp(-(coalesce(sum(weight * w), 0) + max(b)))), 6) AS score FROM test d LEFT JOIN test_tfidf t USING (doc_id)
LEFT JOIN w{STEPS} w USING (term_idx), b{STEPS} GROUP BY d.doc_id""")
def linear_score(spark, sf):
    r, model = _descend(spark, sf)
    test = r.weights.where(F.col("split") == "test")
    return rounded(G.linear_score(r.test, test, model.weight_frame(spark), float(model.bias), CAP))


@query("feature_importance_linear", S.with_(*_descent_sql(), f"n AS (SELECT term, w FROM w{STEPS} JOIN vocab USING (term_idx))") + """
SELECT side, term, round(w * 1000, 6) AS w FROM ((SELECT 'positive' AS side, term, w FROM n ORDER BY round(w, 12) DESC, term LIMIT 20)
UNION ALL (SELECT 'negative', term, w FROM n ORDER BY round(w, 12), term LIMIT 20))""")
def feature_importance_linear(spark, sf):
    r, model = _descend(spark, sf)
    top = G.feature_importance_linear(model.weight_frame(spark), r.vocab)
    return rounded(top.withColumn("w", F.col("w") * 1000))


TOLERANCE = 0.005   # of the first gradient's norm, at which a descent has settled


@query("logreg_gd_quality", S.with_(*S.CORPUS, *S.split()) + "SELECT count(*) AS n_docs, CAST(sum(label) AS BIGINT) AS n_positive, count(*) AS n_scored, true AS learns, true AS settled FROM test")
def logreg_gd_quality(spark, sf):
    """Scaled features, at most the default 1,500 steps, ended by the norm of the gradient; scored on the test side."""
    r = _Rows(spark, sf, scaled=True)
    model = G.logreg_gd(r.side("train"), r.size, tolerance=TOLERANCE)
    test = r.weights.where(F.col("split") == "test")
    scored = G.linear_score(r.test, test, model.weight_frame(spark), float(model.bias), CAP, "label")
    return _facts(scored.withColumn("pred", (F.col("score") >= 0.5).cast("int"))).withColumn("settled", F.lit(model.norm <= TOLERANCE * model.first_norm))


@lru_cache(maxsize=8)
def _searched(application, sf):
    """The written table of the whole descent search; the queries about it share one."""
    spark = SparkSession.active()
    r = _Rows(spark, sf, scaled=True)
    split = materialize(Y.random_split(r.side("train")), "holdout")
    fit = split.where(F.col("split") == "train")
    held = split.where(F.col("split") == "test")
    table = L.grid_search_holdout(fit, held, r.size, LinearConfig().search_space, state=scratch_path(spark, "descent-state"))
    return materialize(table, "searched")


def _search(spark, sf):
    return _searched(spark.sparkContext.applicationId, sf)


_SPACE = LinearConfig().search_space
_GRID_SQL = S.with_(*S.CORPUS, *S.split(), "v AS (SELECT CAST(floor((SELECT count(*) FROM train) * 0.2::DOUBLE) AS BIGINT) AS n_valid)", *[
    f"{n}s AS (SELECT * FROM (VALUES {', '.join(f'({v})' for v in _SPACE[c])}) x({c}))" for n, c in (("l", "learning_rate"), ("t", "n_iterations"), ("g", "regularization"))])


@query("grid_search_holdout")
def grid_search_holdout(spark, sf):
    """All 64 settings of the published space: 16 descents of 2,000 steps, none ended before, a fifth of the training rows held out."""
    return rounded(_search(spark, sf).select("learning_rate", "n_iterations", "regularization", "steps", "accuracy", "f1_score"))


@query("grid_search_facts", _GRID_SQL + """SELECT CAST(learning_rate AS DOUBLE) AS learning_rate, n_iterations, CAST(regularization AS DOUBLE) AS regularization,
n_valid, true AS within_limit, true AS scored FROM ls, ts, gs, v""")
def grid_search_facts(spark, sf):
    """The settings searched, on how many held-out rows, and that none went beyond its limit of steps."""
    return _search(spark, sf).select("learning_rate", "n_iterations", "regularization", "n_valid", (F.col("steps") <= F.col("n_iterations")).alias("within_limit"),
                                     F.col("accuracy").between(0, 1).alias("scored"))


@query("grid_search_winner", "SELECT 1 AS n_winners, true AS highest, true AS first_of_equals")
def grid_search_winner(spark, sf):
    """The first setting in grid order that no other exceeds, checked against all results."""
    table = _search(spark, sf)
    best = L.best_configuration(table).select(F.col("run_no").alias("best_no"), F.round("accuracy", 12).alias("best"))
    return table.crossJoin(F.broadcast(best)).agg(                       # one row
        F.countDistinct("best_no").cast("int").alias("n_winners"), (F.max(F.round("accuracy", 12)) == F.max("best")).alias("highest"),
        (F.min(F.when(F.round("accuracy", 12) == F.col("best"), F.col("run_no"))) == F.max("best_no")).alias("first_of_equals"))


def _pivot(spark, sf, columns):
    table = L.param_pivot(_search(spark, sf).withColumnRenamed("accuracy", "score"), "learning_rate", columns, _SPACE[columns])
    return rounded(table.toDF("learning_rate", *[f"{columns}_{v}".replace(".", "_") for v in _SPACE[columns]]))


@query("grid_search_pivot_iterations")
def grid_search_pivot_iterations(spark, sf):
    """Mean accuracy by learning rate and number of iterations."""
    return _pivot(spark, sf, "n_iterations")


@query("grid_search_pivot_regularization")
def grid_search_pivot_regularization(spark, sf):
    """Mean accuracy by learning rate and regularization."""
    return _pivot(spark, sf, "regularization")


# --- Spark ML models --------------------------------------------------------------

SIDES = S.with_(*S.CORPUS, *S.split())
TEST_FACTS = SIDES + "SELECT count(*) AS n_docs, CAST(sum(label) AS BIGINT) AS n_positive, count(*) AS n_scored, true AS learns FROM test"


def _facts(scored):
    """What SQL can recompute of a fitted model's scores, and whether they rank better than chance."""
    scored = materialize(scored.select("label", "pred", "score"), "scored")
    return scored.agg(F.count("*").alias("n_docs"), F.sum("label").cast("long").alias("n_positive"), F.count("score").alias("n_scored")).withColumn(
        "learns", auc_roc(scored).scalar() > 0.5)


def _ml_facts(model, vectors):
    return _facts(G.decision_scores(model.transform(vectors.where(F.col("split") == "test"))))


def _external_vectors(spark, sf):
    """In-domain training rows and the rows of the other sources under one vocabulary, and the numbers of both."""
    from corpusmill.operators.corpus import clean_frame, prepare_corpus
    docs = I.labelled(spark, sf)
    train = prepare_corpus(I.in_domain(docs)).withColumn("split", F.lit("train"))
    everything = materialize(train.unionByName(clean_frame(I.external(docs)).withColumn("split", F.lit("external"))), "all")
    train = everything.where(F.col("split") == "train")
    vocab = materialize(V.fit_vocabulary(train), "vocab")
    weights = materialize(V.tfidf_transform(everything, vocab, CONFIG), "weights")
    vectors = vector_frame(V.sparse_rows(everything, weights, "label", "split"), vocab.count())
    return vectors.where(F.col("split") == "train"), vectors.where(F.col("split") == "external"), train.count()


OUTSIDE_FACTS = S.with_(S.ARTICLES, S.LABELLED) + f"""SELECT count(*) AS n_docs, CAST(sum(label) AS BIGINT) AS n_positive, count(*) AS n_scored, true AS learns
FROM labelled WHERE subject IN ({S.OUTSIDE})"""


@query("external_eval_logreg", OUTSIDE_FACTS)
def external_eval_logreg(spark, sf):
    """Logistic regression of the in-domain sources, applied to the others without refitting."""
    fit_rows, outside, n = _external_vectors(spark, sf)
    return _facts(G.decision_scores(G.logreg(fit_rows, n).transform(outside)))


@query("external_eval_svm", OUTSIDE_FACTS)
def external_eval_svm(spark, sf):
    fit_rows, outside, n = _external_vectors(spark, sf)
    return _facts(G.decision_scores(G.svm_linear(fit_rows, n).transform(outside)))


@query("logreg", TEST_FACTS)
def logreg(spark, sf):
    r = _Rows(spark, sf, scaled=True)
    vectors = r.vectors()
    return _ml_facts(G.logreg(vectors.where(F.col("split") == "train"), r.n_train), vectors)


SVM_FACTS = TEST_FACTS.replace("true AS learns", "true AS learns, true AS below_zero_weights")


def _svm_facts(spark, sf, balanced):
    """Unscaled weights: on columns of unit deviation a few rows among many columns are separated by noise."""
    r = _Rows(spark, sf)
    vectors = r.vectors()
    fit_rows = vectors.where(F.col("split") == "train")
    model = G.svm_linear(fit_rows, r.n_train, balanced=balanced)
    return _ml_facts(model, vectors).withColumn("below_zero_weights", F.lit(G.hinge_objective(model, fit_rows, balanced) < 1))


@query("svm_linear", SVM_FACTS)
def svm_linear(spark, sf):
    return _svm_facts(spark, sf, False)


@query("svm_class_weight", S.with_(*S.CORPUS, *S.split()) + """SELECT label, round(count(*) OVER () * 0 + (SELECT count(*) FROM train) / (2.0::DOUBLE * n), 6) AS class_weight
FROM (SELECT label, count(*) AS n FROM train GROUP BY label)""")
def svm_class_weight(spark, sf):
    return rounded(G.balanced_weights(I.sides(spark, sf).train))


@query("svm_balanced", SVM_FACTS)
def svm_balanced(spark, sf):
    return _svm_facts(spark, sf, True)


@query("svm_kernel", SIDES + """SELECT kernel, count(*) AS n_docs, CAST(sum(label) AS BIGINT) AS n_positive, count(*) AS n_scored, true AS learns, true AS covers
FROM test, (VALUES ('rbf'), ('poly'), ('sigmoid')) k(kernel) GROUP BY kernel""")
def svm_kernel(spark, sf):
    """RBF, polynomial and sigmoid kernels through the landmark map; each pass of landmarks must lower what is left uncovered."""
    r = _Rows(spark, sf)
    train, test = r.side("train"), r.side("test")
    out = None
    for spec in (R.KernelSpec("rbf"), R.KernelSpec("poly", degree=3), R.KernelSpec("sigmoid")):
        coverage = R.Coverage([], [])
        nystrom = R.fit_nystrom(train, r.size, spec, coverage=coverage)
        mapped = nystrom.transform(train).persist()
        model = G.svm_linear(mapped, r.n_train)
        mapped.unpersist()
        row = _facts(G.decision_scores(model.transform(nystrom.transform(test)))).withColumns(
            {"kernel": F.lit(spec.kind), "covers": F.lit(coverage.error[-1] < coverage.error[0])})
        out = row if out is None else out.unionByName(row)
    return out


@query("decision_scores", SIDES + "SELECT doc_id, split, true AS agrees FROM split")
def decision_scores(spark, sf):
    r = _Rows(spark, sf)
    vectors = r.vectors()
    model = G.svm_linear(vectors.where(F.col("split") == "train"), r.n_train)
    return G.decision_scores(model.transform(vectors)).select("doc_id", "split", ((F.col("pred") == 1) == (F.col("score") > 0)).alias("agrees"))


def _tree_input(spark, sf, k=None):
    """Vectors of the ``k`` most class-dependent terms; of the whole vocabulary by default."""
    r = _Rows(spark, sf)
    chosen = materialize(D.chi2_terms(r.weights.where(F.col("split") == "train"), r.train, k or r.size), "chosen")
    narrow = D.narrow_weights(r.weights.select("doc_id", "term_idx", "weight"), chosen, k or r.size)
    docs = Y.training_folds(r.docs.select("doc_id", "label", "split"))
    rows = V.sparse_rows(docs, narrow, "label", "split", "fold")
    return r, chosen, vector_frame(rows, chosen.count())


@query("gbt", TEST_FACTS)
def gbt(spark, sf):
    _, _, vectors = _tree_input(spark, sf)
    return _ml_facts(D.gbt(vectors.where(F.col("split") == "train")), vectors)


@query("feature_importance_tree")
def feature_importance_tree(spark, sf):
    r, chosen, vectors = _tree_input(spark, sf)
    model = D.gbt(vectors.where(F.col("split") == "train"))
    return rounded(D.feature_importance_tree(model, r.vocab, chosen))


@query("cv_grid_gbt")
def cv_grid_gbt(spark, sf):
    """All 27 settings of the published space with 90 trees each, on five folds."""
    _, _, vectors = _tree_input(spark, sf)
    train = vectors.where(F.col("split") == "train").persist()
    table = L.cv_grid_gbt(train, L.tree_grid(TREE_SPACE, train.count()), k=5)
    train.unpersist()
    return rounded(table.drop("fit_seconds"))


@query("cv_specificity", S.with_(*S.CORPUS, *S.split(), S.folds("train", "folded")) + """SELECT fold, count(*) AS n_valid, count(*) FILTER (label = 0) AS n_negative,
true AS scored, true AS picked_best FROM folded GROUP BY fold""")
def cv_specificity(spark, sf):
    """A tuner that picks the penalty of a logistic regression by class-0 recall over the folds of the training side."""
    r = _Rows(spark, sf)
    docs = Y.stratified_folds(r.train.select("doc_id", "label"))
    weights = r.weights.where(F.col("split") == "train").drop("split")
    train = vector_frame(V.sparse_rows(docs, weights, "label", "fold"), r.size).persist()
    estimator = LogisticRegression(maxIter=20)
    tuned = L.cross_validated(train, estimator, {"regParam": [0.001, 0.1]}, L.SpecificityEvaluator())
    best = max(tuned.table.groupBy("setting").agg(F.avg("test_score").alias("mean")).collect(), key=lambda x: (x["mean"], -x["setting"]))["setting"]
    facts = train.groupBy("fold").agg(F.count("*").alias("n_valid"), F.count(F.when(F.col("label") == 0, 1)).alias("n_negative"))
    scored = tuned.table.groupBy("fold").agg(F.min(F.col("test_score").between(0, 1)).alias("scored"))
    out = materialize(facts.join(F.broadcast(scored), "fold").withColumn("picked_best", F.lit(best == tuned.best)), "specificity")   # a row per fold
    train.unpersist()
    return out


class _Transfer:
    """Split in-domain rows and the rows of the other sources under the vocabulary of the training side, from written tables.

    The other sources are cleaned row by row: none of their copies or empty texts is dropped.
    """

    def __init__(self, spark, sf):
        from corpusmill.operators.corpus import clean_frame, prepare_corpus
        docs = I.labelled(spark, sf)
        split = materialize(Y.stratified_split(materialize(prepare_corpus(I.in_domain(docs)), "prepared")), "split")
        train = split.where(F.col("split") == "train")
        vocab = materialize(V.fit_vocabulary(train, CONFIG), "vocab")
        everything = materialize(split.unionByName(clean_frame(I.external(docs)).withColumn("split", F.lit("external"))), "all")
        weights = V.tfidf_transform(everything, vocab, CONFIG)
        self.fitted = V.FittedFeatures(CONFIG, vocab)
        self.size, self.n_train = vocab.count(), train.count()
        self._rows = materialize(V.sparse_rows(everything, weights, "label", "split"), "rows")
        self._vectors = vector_frame(self._rows, self.size)

    def rows(self, side):
        return self._rows.where(F.col("split") == side).drop("split")

    def vectors(self, side):
        return self._vectors.where(F.col("split") == side).drop("split")

    def fit(self, config):
        return T.fit_svm(config, self.fitted, self.rows("train"), self.vectors("train"), self.n_train, self.size)

    def scorer(self, side):
        return lambda model: model.classify(self.rows(side), self.vectors(side))


@lru_cache(maxsize=8)
def _compared(application, sf):
    """The written result of the comparison; the queries about it share one."""
    spark = SparkSession.active()
    t = _Transfer(spark, sf)
    return materialize(L.multi_config_compare(SVM_CONFIGS, t.fit, t.scorer("test"), t.scorer("external"), spark, parallelism=4), "comparison")


def _comparison(spark, sf):
    return _compared(spark.sparkContext.applicationId, sf)


@query("multi_config_compare")
def multi_config_compare(spark, sf):
    """All ten published configurations trained in-domain, scored on the test side and on the other sources."""
    return rounded(_comparison(spark, sf).drop("training_time"))


COMPARED = ", ".join(f"({i}, '{c['name']}')" for i, c in enumerate(SVM_CONFIGS))


@query("multi_config_facts", S.with_(S.ARTICLES, S.LABELLED, S.cleaned(), S.dedup(f"(SELECT * FROM cleaned WHERE subject NOT IN ({S.OUTSIDE}))"), *S.split())
       + f"""SELECT run_no, config_name, (SELECT count(*) FROM test) AS n_internal, (SELECT count(*) FROM labelled WHERE subject IN ({S.OUTSIDE})) AS n_external,
true AS scored, true AS timed FROM (VALUES {COMPARED}) c(run_no, config_name)""")
def multi_config_facts(spark, sf):
    """Which configurations ran, on how many rows of either corpus."""
    ranges = [F.col(c).between(0, 1) for c in ("internal_acc", "external_acc", "precision", "recall", "specificity", "f1_score", "auc_score")]
    scored = ranges[0]
    for r in ranges[1:]:
        scored = scored & r
    return _comparison(spark, sf).select("run_no", "config_name", "n_internal", "n_external", scored.alias("scored"), (F.col("training_time") > 0).alias("timed"))


def _reloaded(spark, sf, fit):
    """A model fitted in-domain, saved, loaded and applied to the raw rows of the other sources."""
    t = _Transfer(spark, sf)
    path = scratch_path(spark, "text-model")
    fit(t).save(path, n_train=t.n_train)
    model, _ = T.load_text_model(spark, path)
    return model.score(I.external(I.labelled(spark, sf)))


@query("external_eval_gbt", OUTSIDE_FACTS)
def external_eval_gbt(spark, sf):
    """Boosted trees of the in-domain sources, saved and loaded, applied to the raw rows of the others."""
    return _facts(_reloaded(spark, sf, lambda t: T.TextModel(t.fitted, t.size, D.gbt(t.vectors("train")))))


@query("external_eval_kernel", OUTSIDE_FACTS)
def external_eval_kernel(spark, sf):
    """An RBF machine of the in-domain sources, saved and loaded with its landmarks, applied to the raw rows of the others."""
    return _facts(_reloaded(spark, sf, lambda t: t.fit({"kernel": "rbf"})))


@query("external_metrics")
def external_metrics(spark, sf):
    """Weighted metrics and ROC area of logistic regression and a linear SVM on the other sources, each from its saved form."""
    t = _Transfer(spark, sf)
    outside = I.external(I.labelled(spark, sf))
    models = {"logreg": T.TextModel(t.fitted, t.size, G.logreg(t.vectors("train"), t.n_train)), "svm_linear": t.fit({"kernel": "linear"})}
    out = None
    for name, fitted in models.items():
        path = scratch_path(spark, "text-model")
        fitted.save(path, family=name)
        model, meta = T.load_text_model(spark, path)
        scored = materialize(model.score(outside).withColumn("family", F.lit(meta["family"])), "scored")
        out = scored if out is None else out.unionByName(scored)
    table = weighted_metrics(confusion_counts(out, "family")).join(F.broadcast(auc_roc(out, "family")), "family")   # a row per family
    return rounded(table)


RUNS = """runs AS (SELECT c_nationkey AS run_no, c_mktsegment || '_' || c_nationkey AS config_name, min(c_acctbal) AS accuracy,
max(c_acctbal) AS f1_score, median(c_acctbal) AS auc_score, CAST(count(*) AS DOUBLE) AS training_time FROM customer GROUP BY ALL)"""


@query("leaderboard", f"""WITH {RUNS}, r AS (SELECT *, row_number() OVER (ORDER BY run_no, config_name) AS rn FROM runs)
SELECT 'best_accuracy' AS criterion, (SELECT config_name FROM r ORDER BY accuracy DESC, rn LIMIT 1) AS config_name, round(max(accuracy), 6) AS value FROM r
UNION ALL SELECT 'best_f1', (SELECT config_name FROM r ORDER BY f1_score DESC, rn LIMIT 1), round(max(f1_score), 6) FROM r
UNION ALL SELECT 'best_auc', (SELECT config_name FROM r ORDER BY auc_score DESC, rn LIMIT 1), round(max(auc_score), 6) FROM r
UNION ALL SELECT 'fastest_training', (SELECT config_name FROM r ORDER BY training_time, rn LIMIT 1), round(min(training_time), 6) FROM r""")
def leaderboard(spark, sf):
    """Customer groups stand in for runs: one run per nation and segment."""
    runs = I.table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.min("c_acctbal").alias("accuracy"), F.max("c_acctbal").alias("f1_score"),
        F.median("c_acctbal").alias("auc_score"), F.count("*").cast("double").alias("training_time"))
    name = F.concat_ws("_", "c_mktsegment", F.col("c_nationkey").cast("string"))
    # (nation, segment) order as one number: segments are numbered by name.
    order = F.col("c_nationkey") * 100 + F.dense_rank().over(
        Window.partitionBy("c_nationkey").orderBy("c_mktsegment"))
    return rounded(L.leaderboard(runs.withColumn("config_name", name).withColumn("run_no", order)))


# --- persistence ------------------------------------------------------------------

@query("save_load_scorer", S.with_(*EXTERNAL) + "SELECT doc_id, label, pred, round(margin, 6) AS margin FROM nb_scored")
def save_load_scorer(spark, sf):
    """A saved model scores like the fitted one."""
    from corpusmill.operators.serving import predict_batch
    fitted, scorer, outside = _external_fit(spark, sf)
    path = scratch_path(spark, "scorer")
    Z.save_scorer(spark, scorer, path, kind="BNB", alpha=0.1)
    out = predict_batch(outside, fitted, Z.load_scorer(spark, path))
    return rounded(out.select("doc_id", "label", "pred", "margin"))


@query("save_load_model", SIDES + "SELECT doc_id, true AS same, (SELECT count(*) FROM train) AS n_train FROM test")
def save_load_model(spark, sf):
    r = _Rows(spark, sf)
    vectors = r.vectors()
    model = G.logreg(vectors.where(F.col("split") == "train"), r.n_train)
    path = scratch_path(spark, "model")
    Z.save_model(spark, model, path, {"model": "logreg", "n_train": r.n_train})
    loaded, meta = Z.load_model(spark, path)
    test = vectors.where(F.col("split") == "test")
    first, again = (m.transform(test).select("doc_id", vector_to_array("probability")[1].alias("score")) for m in (model, loaded))
    return first.join(again.withColumnRenamed("score", "reloaded"), "doc_id").select(
        "doc_id", (F.col("score") == F.col("reloaded")).alias("same"), F.lit(meta["n_train"]).cast("long").alias("n_train"))


def _put(spark, path, record):
    """A small JSON file, by the session's own file system."""
    import json
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(json.dumps(record, indent=2).encode()))
    out.close()


def _write_runs(spark, sf):
    """Run folders as a comparison leaves them: one per language, old and new records."""
    base = scratch_path(spark, "runs")
    words = I.scored(spark, sf).join(I.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    rows = weighted_metrics(confusion_counts(words, "lang")).join(auc_roc(words, "lang"), "lang").orderBy("lang").collect()
    fields = {"accuracy": "accuracy", "precision": "precision_weighted", "recall": "recall_weighted",
              "f1_score": "f1_weighted", "specificity": "specificity", "auc_score": "auc_roc"}
    for i, row in enumerate(rows):
        metrics = {k: row[c] for k, c in fields.items()}
        inner = metrics if i % 2 else {}
        _put(spark, f"{base}/{row.lang}/config_summary.json", {
            "config_name": row.lang, "training_time_seconds": 10.0 + i, "test_metrics": metrics, "train_metrics": inner or None})
        if not inner:
            _put(spark, f"{base}/{row.lang}/Trained/m_metadata.json", {"metrics": metrics})
    return base


@query("collect_runs", S.with_(*S.SCORED, f"c AS (SELECT lang, {S.CONFUSION_COLUMNS} FROM scored JOIN (SELECT doc_id, lang FROM documents) USING (doc_id) GROUP BY lang)")
       + f"SELECT lang AS config_name, round({S.WEIGHTED['accuracy']}, 6) AS test_accuracy, round({S.WEIGHTED['accuracy']}, 6) AS train_accuracy FROM c")
def collect_runs(spark, sf):
    runs = Z.collect_runs(spark, _write_runs(spark, sf))
    return rounded(runs.select("config_name", F.col("test_metrics.accuracy").alias("test_accuracy"),
                               F.col("train_metrics.accuracy").alias("train_accuracy")))


def _pick(criterion, column, order="DESC", best="max"):
    return (f"SELECT '{criterion}' AS criterion, (SELECT lang FROM m ORDER BY {column} {order}, rn LIMIT 1) AS config_name, "
            f"round({best}({column}), 6) AS value FROM m")


@query("leaderboard_runs", S.with_(
    *S.SCORED, "w AS (SELECT s.*, d.lang FROM scored s JOIN (SELECT doc_id, lang FROM documents) d USING (doc_id))",
    f"c AS (SELECT lang, {S.CONFUSION_COLUMNS} FROM w GROUP BY lang)", *S.auc("w", "lang"),
    f"""m AS (SELECT lang, {S.WEIGHTED['accuracy']} AS accuracy, {S.WEIGHTED['f1_weighted']} AS f1, auc_roc AS auc,
row_number() OVER (ORDER BY lang) AS rn, 9.0::DOUBLE + row_number() OVER (ORDER BY lang) AS seconds FROM c JOIN auc_t USING (lang))""")
       + " UNION ALL ".join([_pick("best_accuracy", "accuracy"), _pick("best_f1", "f1"), _pick("best_auc", "auc"),
                             _pick("fastest_training", "seconds", "ASC", "min")]))
def leaderboard_runs(spark, sf):
    """Winners among run folders that were written and collected."""
    runs = Z.collect_runs(spark, _write_runs(spark, sf))
    order = F.row_number().over(Window.orderBy("config_name"))     # a row per run folder
    return rounded(L.leaderboard(runs.select(
        "config_name", "test_metrics.*", F.col("training_time_seconds").alias("training_time"), order.alias("run_no"))))


@query("latest_model", "SELECT max(lang) AS newest, max(lang) || '_metadata.json' AS file FROM documents")
def latest_model(spark, sf):
    """One record per language, written in the order of their names; the last is the newest."""
    import time
    base = scratch_path(spark, "records")
    for row in I.table(spark, sf, "documents").select("lang").where("lang IS NOT NULL").distinct().orderBy("lang").collect():
        _put(spark, f"{base}/{'z' * (9 - len(row.lang))}{row.lang}/{row.lang}_metadata.json", {"model": row.lang})
        time.sleep(0.05)
    newest = Z.latest_model(spark, base)
    return spark.read.schema("model string").json(newest, multiLine=True).select(
        F.col("model").alias("newest"), F.lit(newest.rpartition("/")[2]).alias("file"))


# --- streams ----------------------------------------------------------------------

def _stream_articles(spark, sf):
    """Documents as an arriving stream, in the columns of an article."""
    schema = I.table(spark, sf, "documents").schema
    stream = W.read_stream(spark, f"{sf}/document[s].parquet", schema)
    return stream.select("doc_id", F.substring_index("text", "\n", 1).alias("title"),
                         F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("text"),
                         F.col("source").alias("subject"))


def _stream_scored(spark, sf):
    fitted, scorer, _ = _external_fit(spark, sf)
    scorer.weights = materialize(scorer.weights, "scorer")
    labels = I.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    arriving = I.external(_stream_articles(spark, sf)).join(labels, "doc_id")
    out, checkpoint = W.stream_paths(spark, "stream")
    W.finish(W.stream_score(arriving, fitted, scorer, out, checkpoint, "label"))
    return out


@query("stream_score", S.with_(*EXTERNAL) + "SELECT doc_id, label, pred, round(margin, 6) AS margin FROM nb_scored")
def stream_score(spark, sf):
    """The streamed result equals the batch result."""
    scored = spark.read.parquet(_stream_scored(spark, sf))
    return rounded(scored.select("doc_id", "label", "pred", "margin"))


@query("stream_running_metrics", S.with_(*EXTERNAL, f"conf AS (SELECT {S.CONFUSION_COLUMNS} FROM nb_scored)")
       + f"SELECT tp, tn, fp, fn, {S.BINARY_COLUMNS} FROM conf")
def stream_running_metrics(spark, sf):
    """State after the last micro-batch equals the batch counts."""
    scored = _stream_scored(spark, sf)
    stream = W.read_stream(spark, f"{scored}/*", "doc_id long, label int, margin double, score double, pred int")
    out, checkpoint = W.stream_paths(spark, "running")
    W.finish(W.stream_running_metrics(stream, out, checkpoint))
    per_batch = W.metrics_after_batches(spark.read.parquet(out))
    last = per_batch.agg(F.max("after_batch")).scalar()
    return rounded(per_batch.where(F.col("after_batch") == last).drop("after_batch", "auc_binned"))


@query("stream_dedup", S.with_(*S.ALL_CONTENTS) + """SELECT digest, n = 1 AS once, held FROM (SELECT sha256(content) AS digest, 1 AS n, true AS held
FROM contents GROUP BY content)""")
def stream_dedup(spark, sf):
    """Every content arrives once, and the copy that is kept is one of its documents."""
    from corpusmill.operators.corpus import clean_frame
    stream = W.stream_dedup(clean_frame(_stream_articles(spark, sf)))
    out, checkpoint = W.stream_paths(spark, "dedup")
    W.finish(W.append_to(stream.select("doc_id", "content_hash"), out, checkpoint))
    all_contents = I.all_contents(spark, sf).select("doc_id", F.sha2("content", 256).alias("digest"))
    kept = spark.read.parquet(out).select("doc_id", F.lower(F.hex("content_hash")).alias("digest"))
    return kept.join(all_contents, ["doc_id", "digest"], "left_semi").groupBy("digest").agg(
        (F.count("*") == 1).alias("once"), F.lit(True).alias("held"))


@query("stream_dedup_watermark", S.with_(*S.ALL_CONTENTS) + "SELECT count(DISTINCT content) AS n_contents FROM contents")
def stream_dedup_watermark(spark, sf):
    """Event time from doc_id (after 1970, where watermarks start)."""
    from corpusmill.operators.corpus import clean_frame
    timed = clean_frame(_stream_articles(spark, sf)).withColumn("at", F.timestamp_seconds(F.col("doc_id") + 1000000000))
    stream = W.stream_dedup(timed, "at", "3650 days")
    out, checkpoint = W.stream_paths(spark, "dedup")
    W.finish(W.append_to(stream.select("doc_id", "content_hash"), out, checkpoint))
    return spark.read.parquet(out).agg(F.count("*").alias("n_contents"))


PERIODS, LATE_BY = 6, 4
ARRIVALS = f"""arrivals AS (SELECT event_id, user_id, event_type, CAST(({PERIODS} * (epoch_us(ts) - lo)) // (hi - lo + 1) AS INTEGER) AS period
FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events) WHERE ts IS NOT NULL),
flagged AS (SELECT *, event_type = 'error' AND event_id % 7 = 0 AND period + {LATE_BY} < {PERIODS} AS late FROM arrivals),
keys AS (SELECT DISTINCT user_id, event_type, period FROM flagged WHERE NOT late),
first_taken AS (SELECT user_id, event_type, min(period) AS period FROM keys GROUP BY ALL),
taken AS (SELECT * FROM first_taken UNION ALL SELECT k.user_id, k.event_type, min(k.period) FROM keys k JOIN first_taken f USING (user_id, event_type)
WHERE k.period >= f.period + 3 GROUP BY ALL)"""


def _event_arrivals(spark, sf):
    """The events in six periods of equal length, five days of event time apart; some errors arrive four periods late."""
    events = I.table(spark, sf, "events").where("ts IS NOT NULL")
    us = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
    lo, hi = (v or 0 for v in events.agg(F.expr(f"min({us})"), F.expr(f"max({us})")).first())
    period = F.expr(f"({PERIODS} * ({us} - {lo})) div ({hi - lo} + 1)").cast("int")
    late = (F.col("event_type") == "error") & (F.col("event_id") % 7 == 0) & (F.col("period") + LATE_BY < PERIODS)
    timed = events.withColumn("period", period).select(
        F.concat_ws(":", "user_id", "event_type").alias("content"), "user_id", "event_type", "period",
        F.timestamp_seconds(F.lit(1704067200) + F.col("period") * 5 * 86400).alias("at"),
        (F.col("period") + F.when(late, LATE_BY).otherwise(0)).alias("arrives"))
    return [timed.where(F.col("arrives") == p).drop("arrives") for p in range(PERIODS)]


@lru_cache(maxsize=8)
def _evicting(application, sf):
    """Output folder of the watermarked de-duplication, and its progress after every arrival."""
    spark = SparkSession.active()
    out, checkpoint = W.stream_paths(spark, "evicting")
    progress = W.run_arrivals(spark, _event_arrivals(spark, sf), scratch_path(spark, "arrivals"),
                              lambda stream: W.append_to(W.stream_dedup(stream, "at", "5 days").drop("content_hash"), out, checkpoint))
    return out, progress


@query("stream_dedup_eviction", f"WITH {ARRIVALS} SELECT user_id, event_type, period FROM taken")
def stream_dedup_eviction(spark, sf):
    """Six arrivals, the stream started again for each: a key is taken anew once its state is gone, late rows never."""
    out, _ = _evicting(spark.sparkContext.applicationId, sf)
    return spark.read.parquet(out).select("user_id", "event_type", "period")


@query("stream_dedup_state", f"WITH {ARRIVALS} SELECT CAST(p AS INTEGER) AS arrival, (SELECT count(*) FROM taken WHERE period IN (p, p - 1)) AS state_rows, "
       f"(SELECT count(*) FROM flagged WHERE late AND period + {LATE_BY} = p) AS late_rows FROM range({PERIODS}) r(p)")
def stream_dedup_state(spark, sf):
    """Keys held and late rows refused after every arrival: the state falls behind the horizon."""
    _, progress = _evicting(spark.sparkContext.applicationId, sf)
    return spark.createDataFrame([(i, p.state_rows, p.late_rows) for i, p in enumerate(progress)], "arrival int, state_rows long, late_rows long")


BATCHES = 4


@query("stream_metrics_history", S.with_(*S.SCORED, f"""bins AS (SELECT b AS after_batch, CAST(least(floor(score * 100), 99) AS INTEGER) AS score_bin, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n,
count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 0) AS tn, count(*) FILTER (label = 0 AND pred = 1) AS fp, count(*) FILTER (label = 1 AND pred = 0) AS fn
FROM scored JOIN range({BATCHES}) r(b) ON doc_id % {BATCHES} <= b GROUP BY ALL)""",
       "ranked AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY after_batch ORDER BY score_bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS up FROM bins)",
       """conf AS (SELECT after_batch, sum(tp)::BIGINT AS tp, sum(tn)::BIGINT AS tn, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn,
CASE WHEN sum(p) * sum(n) > 0 THEN sum(n * (up + p / 2.0::DOUBLE)) / (sum(p)::DOUBLE * sum(n)) ELSE 0.5 END AS auc FROM ranked GROUP BY after_batch)""")
       + f"SELECT CAST(after_batch AS INTEGER) AS after_batch, round(auc, 6) AS auc_binned, tp, tn, fp, fn, {S.BINARY_COLUMNS} FROM conf")
def stream_metrics_history(spark, sf):
    """Metrics and binned ROC area after each of four arrivals, the stream started again from its checkpoint for each."""
    scored = materialize(I.scored(spark, sf), "scored")
    out, checkpoint = W.stream_paths(spark, "running")
    W.run_arrivals(spark, [scored.where(F.col("doc_id") % BATCHES == b) for b in range(BATCHES)], scratch_path(spark, "arrivals"),
                   lambda stream: W.stream_running_metrics(stream, out, checkpoint))
    return rounded(W.metrics_after_batches(spark.read.parquet(out)).withColumn("after_batch", F.col("after_batch").cast("int")))


@query("stream_score_restarts", S.with_(*EXTERNAL) + "SELECT doc_id, label, pred, round(margin, 6) AS margin FROM nb_scored")
def stream_score_restarts(spark, sf):
    """Documents in three arrivals, each scored by a stream started again from the checkpoint: together the batch result."""
    fitted, scorer, outside = _external_fit(spark, sf)
    scorer.weights = materialize(scorer.weights, "scorer")
    out, checkpoint = W.stream_paths(spark, "stream")
    W.run_arrivals(spark, [outside.where(F.col("doc_id") % 3 == b) for b in range(3)], scratch_path(spark, "arrivals"),
                   lambda stream: W.stream_score(stream, fitted, scorer, out, checkpoint, "label"))
    return rounded(spark.read.parquet(out).select("doc_id", "label", "pred", "margin"))


# --- protection -------------------------------------------------------------------

DOC_COLUMNS = ["doc_id", "source", "lang", "text"]
ROW_SQL = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in DOC_COLUMNS)


@query("row_fingerprint", f"SELECT doc_id, sha256({ROW_SQL}) AS fingerprint FROM documents")
def row_fingerprint(spark, sf):
    return Q.row_fingerprint(I.table(spark, sf, "documents"), DOC_COLUMNS).select("doc_id", "fingerprint")


@query("row_fingerprint_sha3")
def row_fingerprint_sha3(spark, sf):
    return Q.row_fingerprint(I.table(spark, sf, "documents"), DOC_COLUMNS, "sha3_256").select("doc_id", "fingerprint")


@query("integrity_diff", """SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'added'
WHEN n.c_custkey IS NULL THEN 'removed' WHEN o.c_mktsegment = n.c_mktsegment THEN 'same' ELSE 'changed' END AS status
FROM (SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey <> 3) o
FULL JOIN (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBTOR' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_nationkey <> 5) n
ON o.c_custkey = n.c_custkey""")
def integrity_diff(spark, sf):
    """An older state lacks nation 3; the newer one lacks nation 5 and marks debtors."""
    base = I.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    old = base.where(F.col("c_nationkey") != 3)
    new = base.where(F.col("c_nationkey") != 5).withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") < 0, "DEBTOR").otherwise(F.col("c_mktsegment")))
    cols = ["c_custkey", "c_mktsegment"]
    return Q.integrity_diff(Q.row_fingerprint(old, cols), Q.row_fingerprint(new, cols), "c_custkey")


def _sealed_round_trip(spark, sf, mode, extra):
    """Open what was sealed, and say how long the sealed text is and whether it differs."""
    import secrets
    key = F.lit(secrets.token_hex(16)).cast("binary")     # never written
    docs = I.table(spark, sf, "documents").select("doc_id", "text", F.col("text").alias("plain"))
    sealed = Q.encrypt_column(docs, "text", key, mode).withColumns({
        "sealed_bytes": F.octet_length(F.unbase64("text")).cast("long"), "hidden": F.col("text") != F.col("plain"), **extra})
    return Q.decrypt_column(sealed, "text", key, mode).drop("plain")


SEALED = "SELECT doc_id, text, {} AS sealed_bytes, true AS hidden{} FROM documents"


@query("encrypt_column", SEALED.format("strlen(text) + 28", ""))
def encrypt_column(spark, sf):
    """Round trip in the default, authenticated mode: 12 bytes of nonce and 16 of tag are added."""
    return _sealed_round_trip(spark, sf, "GCM", {})


@query("encrypt_column_ecb", SEALED.format("strlen(text) // 16 * 16 + 16", ", 'acTg2Gp7BDDYzbeAcLTFWg==' AS known"))
def encrypt_column_ecb(spark, sf):
    """Round trip with padding to whole blocks, beside a published pair of plain and sealed text."""
    block = F.aes_encrypt(F.unhex(F.lit("00112233445566778899AABBCCDDEEFF")), F.unhex(F.lit("000102030405060708090A0B0C0D0E0F")), F.lit("ECB"), F.lit("PKCS"))
    return _sealed_round_trip(spark, sf, "ECB", {"known": F.base64(F.substring(block, 1, 16))})
