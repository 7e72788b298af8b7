"""Splits, TF-IDF features, scaling, encoding, feature tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions.numeric import smooth_idf, sublinear_tf
from corpusmill.operators import profile as P
from corpusmill.operators import split as Y
from corpusmill.operators import terms as X
from corpusmill.operators import tfidf as V
from corpusmill.operators.naive_bayes import label_term_sums
from corpusmill.operators.scaling import apply_normalization, fit_normalization
from corpusmill.operators.validation import validate_features
from corpusmill.plans import inputs as I
from corpusmill.plans import sql as S
from corpusmill.plans.registry import query, rounded
from corpusmill.session import materialize, scratch_path
from corpusmill.sources import sinks as K

CONFIG = FeatureConfig()
CAP = CONFIG.max_features
W_SPLIT = S.with_(*S.CORPUS, *S.split())


# --- splits -------------------------------------------------------------------

@query("stratified_split", W_SPLIT + "SELECT doc_id, label, split FROM split")
def stratified_split(spark, sf):
    return I.split_corpus(spark, sf).select("doc_id", "label", "split")


@query("random_split", S.with_(*S.CORPUS) + """SELECT doc_id, label,
CASE WHEN row_number() OVER (ORDER BY md5(doc_id || ':42')) <= floor((SELECT count(*) FROM corpus) * 0.2::DOUBLE)
THEN 'test' ELSE 'train' END AS split FROM corpus""")
def random_split(spark, sf):
    return Y.random_split(I.corpus(spark, sf)).select("doc_id", "label", "split")


@query("stratified_kfold", S.with_(*S.CORPUS, S.folds("corpus", "folded")) + "SELECT doc_id, label, fold FROM folded")
def stratified_kfold(spark, sf):
    return Y.stratified_folds(I.corpus(spark, sf)).select("doc_id", "label", "fold")


@query("split_all_documents", S.with_(*S.ALL_CONTENTS, S.dedup("contents", "kept", order="doc_id")) + """SELECT doc_id,
CASE WHEN row_number() OVER (ORDER BY md5(doc_id || ':42')) <= floor((SELECT count(*) FROM kept) * 0.2::DOUBLE)
THEN 'test' ELSE 'train' END AS split FROM kept""")
def split_all_documents(spark, sf):
    return Y.random_split(I.deduplicated(spark, sf)).select("doc_id", "split")


# --- weights --------------------------------------------------------------------

@query("sublinear_tf", S.with_(*S.CORPUS, *S.postings("corpus")) + "SELECT doc_id, term, round(1.0::DOUBLE + ln(tf::DOUBLE), 6) AS w FROM posts")
def sublinear(spark, sf):
    return rounded(X.postings(I.corpus(spark, sf)).select("doc_id", "term", sublinear_tf(F.col("tf")).alias("w")))


@query("smooth_idf", S.with_(*S.CORPUS, *S.postings("corpus"),
       "n AS (SELECT count(*) AS n FROM corpus)") + """SELECT term, round(ln((1 + n) / (1 + count(*))::DOUBLE) + 1, 6) AS idf
FROM posts, n GROUP BY term, n""")
def idf(spark, sf):
    docs = I.corpus(spark, sf)
    stats = X.term_stats(X.postings(docs))
    return rounded(stats.select("term", smooth_idf(V.row_count(docs), F.col("df")).alias("idf")))


@query("tfidf_fit", S.with_(*S.TRAIN_FEATURES) + "SELECT term, term_idx, cf, df, round(idf, 6) AS idf FROM vocab")
def tfidf_fit(spark, sf):
    return rounded(V.fit_vocabulary(I.sides(spark, sf).train))


@query("tfidf_transform", S.with_(*S.TRAIN_FEATURES, *S.TEST_FEATURES)
       + "SELECT doc_id, label, term, term_idx, tf, round(weight, 6) AS weight FROM test_tfidf")
def tfidf_transform(spark, sf):
    s = I.sides(spark, sf)
    return rounded(V.tfidf_transform(s.test, V.fit_vocabulary(s.train), CONFIG, "label"))


@query("l2_normalize", S.with_(*S.TRAIN_FEATURES) + "SELECT doc_id, round(sum(weight * weight), 6) AS norm FROM tfidf GROUP BY doc_id")
def l2_normalize(spark, sf):
    train = I.sides(spark, sf).train
    weights = V.tfidf_transform(train, V.fit_vocabulary(train))
    return rounded(weights.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("norm")))


@query("vocab_lookup", S.with_(*S.TRAIN_FEATURES, *S.postings("test", "test_"))
       + "SELECT p.doc_id, p.term, p.tf, v.term_idx FROM test_posts p JOIN vocab v USING (term)")
def vocab_lookup(spark, sf):
    s = I.sides(spark, sf)
    vocab = V.fit_vocabulary(s.train).select("term", "term_idx")
    return V.vocab_lookup(X.postings(s.test), vocab, CAP).select("doc_id", "term", "tf", "term_idx")


@query("doc_anti_empty", S.with_(*S.TRAIN_FEATURES, *S.TEST_FEATURES) + """SELECT d.doc_id, count(t.term) AS n_terms,
round(coalesce(sum(weight), 0), 6) AS total FROM test d LEFT JOIN test_tfidf t USING (doc_id) GROUP BY d.doc_id""")
def doc_anti_empty(spark, sf):
    s = I.sides(spark, sf)
    weights = V.tfidf_transform(s.test, V.fit_vocabulary(s.train))
    rows = V.sparse_rows(s.test, weights)
    return rounded(rows.select("doc_id", F.size("idx").cast("long").alias("n_terms"),
                               F.aggregate("val", F.lit(0.0), lambda a, v: a + v).alias("total")))


@query("tfidf_vectors", S.with_(*S.TRAIN_FEATURES, *S.TEST_FEATURES) + """SELECT d.doc_id, CAST(count(t.term) AS BIGINT) AS n_active,
(SELECT count(*) FROM vocab) AS width FROM test d LEFT JOIN test_tfidf t USING (doc_id) GROUP BY d.doc_id""")
def tfidf_vectors(spark, sf):
    """Sparse ML vectors; the plain numbers of each vector come back."""
    from corpusmill.operators.vectors import vector_frame
    s = I.sides(spark, sf)
    vocab = materialize(V.fit_vocabulary(s.train), "vocab")
    width = vocab.count()
    vectors = vector_frame(V.sparse_rows(s.test, V.tfidf_transform(s.test, vocab)), width)
    plain = vectors.select("doc_id", vector_to_array("features").alias("v"))
    return plain.select("doc_id", F.size(F.filter("v", lambda x: x != 0)).cast("long").alias("n_active"),
                        F.size("v").cast("long").alias("width"))


@query("subject_onehot", S.with_(S.ARTICLES, S.LABELLED, "fit AS (SELECT DISTINCT subject FROM labelled WHERE subject NOT IN (" + S.OUTSIDE + "))",
       "idx AS (SELECT subject, row_number() OVER (ORDER BY subject) - 1 AS subject_idx FROM fit)")
       + "SELECT doc_id, CAST(subject_idx AS INTEGER) AS subject_idx, 1.0::DOUBLE AS value FROM labelled JOIN idx USING (subject)")
def subject_onehot(spark, sf):
    """Categories come from the in-domain sources; the others are unknown."""
    docs = I.labelled(spark, sf)
    return V.subject_onehot(docs, V.fit_subjects(I.in_domain(docs)))


@query("assemble_features", S.with_(S.ARTICLES, S.LABELLED, S.cleaned(), S.dedup(keys="content, subject"), *S.split(),
       *S.postings("train"), *S.vocab("train"), *S.postings("test", "test_"), *S.tfidf("test_posts", "vocab", "test_tfidf"),
       "subj AS (SELECT subject, row_number() OVER (ORDER BY subject) - 1 AS subject_idx FROM (SELECT DISTINCT subject FROM train))") + """
SELECT doc_id, CAST(term_idx AS INTEGER) AS term_idx, round(weight, 6) AS weight FROM test_tfidf UNION ALL
SELECT doc_id, CAST(subject_idx + (SELECT count(*) FROM vocab) AS INTEGER), 1.0::DOUBLE FROM test JOIN subj USING (subject)""")
def assemble_features(spark, sf):
    config = FeatureConfig(include_subject=True)
    split = materialize(Y.stratified_split(materialize(I.corpus(spark, sf, config), "prepared")), "split")
    train, test = (split.where(F.col("split") == x) for x in ("train", "test"))
    vocab = V.fit_vocabulary(train, config)
    onehot = V.subject_onehot(test, V.fit_subjects(train))
    return rounded(V.with_subject_features(V.tfidf_transform(test, vocab, config), onehot, V.row_count(vocab)))


SCALE = ["scale AS (SELECT term_idx, CASE WHEN var > 1e-15 * q THEN sqrt(var) ELSE 1.0 END AS scale FROM (SELECT term_idx, "
         "sum(weight * weight) / n AS q, greatest(sum(weight * weight) / n - (sum(weight) / n) ** 2, 0) AS var FROM tfidf, "
         "(SELECT count(*)::DOUBLE AS n FROM train) GROUP BY term_idx, n))"]


@query("scale_features", S.with_(*S.TRAIN_FEATURES, *S.TEST_FEATURES, *SCALE) + """SELECT doc_id, term_idx,
round(weight / coalesce(scale, 1), 6) AS weight FROM test_tfidf LEFT JOIN scale USING (term_idx)""")
def scale_features(spark, sf):
    s = I.sides(spark, sf)
    fitted = V.fit_features(s.train)
    return rounded(fitted.transform(s.test, scaled=True).select("doc_id", "term_idx", "weight"))


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _norm_sql(expr):
    return ("WITH " + ", ".join(
        f"p_{c} AS (SELECT avg({c}) AS mean, stddev_pop({c}) AS sd, min({c}) AS lo, max({c}) AS hi FROM lineitem)" for c in MEASURES)
        + " SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({expr.format(c=c)}, 6) AS {c}" for c in MEASURES)
        + " FROM lineitem, " + ", ".join(f"p_{c}" for c in MEASURES))


def _normalized(spark, sf, method):
    df = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    return rounded(apply_normalization(df, fit_normalization(df, MEASURES, method)))


@query("normalize_standardize", _norm_sql("({c} - p_{c}.mean) / p_{c}.sd"))
def normalize_standardize(spark, sf):
    return _normalized(spark, sf, "standardize")


@query("normalize_minmax", _norm_sql("({c} - p_{c}.lo) / (p_{c}.hi - p_{c}.lo)"))
def normalize_minmax(spark, sf):
    return _normalized(spark, sf, "minmax")


@query("label_term_sums", S.with_(*S.TRAIN_FEATURES, *S.NB_SUMS) + """SELECT term_idx, round(f0, 6) AS f0, round(f1, 6) AS f1,
d0, d1 FROM nb_sums""")
def term_sums(spark, sf):
    train = I.sides(spark, sf).train
    return rounded(label_term_sums(V.tfidf_transform(train, V.fit_vocabulary(train), CONFIG, "label")))


STATS_SQL = """SELECT split, count(*) AS n_samples, count(*) FILTER (label = 0) AS fake_0, count(*) FILTER (label = 1) AS real_1,
(SELECT count(*) FROM vocab) AS n_features_text, (SELECT count(*) FROM vocab) AS n_features_total, false AS include_subject, true AS scaled FROM split GROUP BY split"""


@query("corpus_stats", S.with_(*S.TRAIN_FEATURES) + STATS_SQL)
def corpus_stats(spark, sf):
    s = I.sides(spark, sf)
    return P.corpus_stats(s.all, V.fit_vocabulary(s.train))


@query("write_run_metadata", S.with_(*S.TRAIN_FEATURES) + STATS_SQL)
def write_run_metadata(spark, sf):
    s = I.sides(spark, sf)
    stats = P.corpus_stats(s.all, V.fit_vocabulary(s.train))
    path = scratch_path(spark, "run")
    K.write_run_metadata(spark, path, CONFIG, stats)
    return spark.read.schema(stats.schema).json(f"{path}/stats")


@query("validate_features", S.with_(*S.TRAIN_FEATURES, *S.TEST_FEATURES) + """SELECT 'rows_match_labels' AS "check",
count(*) = count(label) AS passed FROM split UNION ALL
SELECT 'labels_binary', bool_and(label IN (0, 1)) FROM split UNION ALL
SELECT 'all_finite', bool_and(isfinite(weight)) FROM (SELECT weight FROM tfidf UNION ALL SELECT weight FROM test_tfidf) UNION ALL
SELECT 'train_not_empty', count(*) > 0 FROM tfidf UNION ALL SELECT 'test_not_empty', count(*) > 0 FROM test_tfidf UNION ALL
SELECT 'width_within_vocabulary', max(term_idx) < 20000 FROM (SELECT term_idx FROM tfidf UNION ALL SELECT term_idx FROM test_tfidf)""")
def validate(spark, sf):
    s = I.sides(spark, sf)
    weights = V.tfidf_transform(s.all, V.fit_vocabulary(s.train), CONFIG, "split")
    return validate_features(s.all, weights, CAP)


def feature_build(spark, sf):
    """The full build: split corpus, vocabulary and weights end in tables."""
    from corpusmill.plans.build import build_features
    return build_features(I.labelled(spark, sf), scratch_path(spark, "features"), CONFIG)


@query("build_features", S.with_(*S.TRAIN_FEATURES, *S.TEST_FEATURES) + """SELECT split, scaled, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_values FROM
(SELECT split, doc_id, count(term) AS n FROM (SELECT 'train' AS split, d.doc_id, t.term FROM train d LEFT JOIN tfidf t USING (doc_id)
UNION ALL SELECT 'test', d.doc_id, t.term FROM test d LEFT JOIN test_tfidf t USING (doc_id)) GROUP BY split, doc_id),
(SELECT unnest([false, true]) AS scaled) GROUP BY split, scaled""")
def build(spark, sf):
    built = feature_build(spark, sf)
    both = built.features(True).unionByName(built.features(False))
    return both.groupBy("split", "scaled").agg(F.count("*").alias("n_docs"), F.sum(F.size("idx")).alias("n_values"))


@query("read_features", S.with_(*S.TRAIN_FEATURES, *S.TEST_FEATURES) + """SELECT d.doc_id, d.label, count(t.term) AS n_values,
round(coalesce(sum(weight), 0), 6) AS total FROM test d LEFT JOIN test_tfidf t USING (doc_id) GROUP BY d.doc_id, d.label""")
def read_features(spark, sf):
    """Written features read back: only the folder of the test side is scanned."""
    one = feature_build(spark, sf).features(False, "test")
    return rounded(one.select("doc_id", "label", F.size("idx").cast("long").alias("n_values"),
                              F.aggregate("val", F.lit(0.0), lambda a, v: a + v).alias("total")))
