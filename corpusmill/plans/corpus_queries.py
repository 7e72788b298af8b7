"""Loading, cleaning, de-duplication and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions import text as T
from corpusmill.functions.accents import strip_accents
from corpusmill.functions.numeric import class_name
from corpusmill.operators import corpus as C
from corpusmill.operators import profile as P
from corpusmill.operators import terms as X
from corpusmill.operators.validation import distinct_labels
from corpusmill.plans import inputs as I
from corpusmill.plans import sql as S
from corpusmill.plans.registry import query, rounded
from corpusmill.session import scratch_path
from corpusmill.sources import readers as R
from corpusmill.sources import sinks as K

W_CORPUS = S.with_(*S.CORPUS)
W_LABELLED = S.with_(S.ARTICLES, S.LABELLED)
W_ALL = S.with_(*S.ALL_CONTENTS)
FIRST_ROWS = 100


# --- sources ------------------------------------------------------------------

def _write_class_csv(spark, sf, label):
    path = scratch_path(spark, f"class{label}")
    (I.labelled(spark, sf).where(F.col("label") == label)
     .select("doc_id", "title", "text", "subject", "date")
     .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    return path


@query("load_labelled_pair", W_LABELLED + "SELECT doc_id, title, text, subject, label FROM labelled")
def load_labelled_pair(spark, sf):
    schema = "doc_id long, " + R.ARTICLE
    pair = R.load_labelled_pair(spark, _write_class_csv(spark, sf, 0), _write_class_csv(spark, sf, 1), schema)
    return R.fill_missing(pair).select("doc_id", "title", "text", "subject", "label")


@query("load_external", W_LABELLED + f"""SELECT doc_id, title, text, label FROM labelled
WHERE subject IN ({S.OUTSIDE})""")
def load_external(spark, sf):
    path = scratch_path(spark, "external")
    (I.external(I.labelled(spark, sf)).select("doc_id", "title", "text", F.col("label").alias("target"))
     .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    schema = "doc_id long, title string, text string, target int"
    return R.load_external(spark, path, schema).select("doc_id", "title", "text", "label")


@query("load_csv_optional_label", S.with_(S.ARTICLES) + "SELECT doc_id, title, text, subject FROM articles")
def load_csv_optional_label(spark, sf):
    path = scratch_path(spark, "unlabelled")
    (I.articles(spark, sf).select("doc_id", "title", "text", "subject")
     .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    return R.load_csv_optional_label(spark, path)


@query("limit_rows", W_LABELLED + f"SELECT doc_id, title FROM labelled ORDER BY doc_id LIMIT {FIRST_ROWS}")
def limit_rows(spark, sf):
    return R.limit_rows(I.labelled(spark, sf).select("doc_id", "title"), FIRST_ROWS)


@query("write_labels", W_CORPUS + "SELECT doc_id, label FROM corpus")
def write_labels(spark, sf):
    path = scratch_path(spark, "labels")
    K.write_labels(I.corpus(spark, sf), path)
    return spark.read.option("header", True).schema("doc_id long, label int").csv(path)


@query("load_config", S.with_(S.ARTICLES, S.LABELLED, S.cleaned(), "kept AS (SELECT * FROM cleaned WHERE length(content) > 0)") + """SELECT count(*) FILTER (label = 0) AS fake_0,
count(*) FILTER (label = 1) AS real_1, 1234 AS max_features, 0.25::DOUBLE AS test_size FROM kept""")
def load_config(spark, sf):
    """A written configuration drives the preparation of the corpus: it keeps copies."""
    from corpusmill.config import feature_config_from_json, feature_config_to_json
    path = scratch_path(spark, "config")
    written = feature_config_to_json(FeatureConfig(max_features=1234, test_size=0.25, drop_exact_duplicates=False))
    spark.createDataFrame([(written,)], "value string").coalesce(1).write.text(path)
    config = feature_config_from_json("\n".join(r.value for r in spark.read.text(path).collect()))
    return P.class_counts(I.corpus(spark, sf, config)).withColumns({"max_features": F.lit(config.max_features), "test_size": F.lit(config.test_size)})


# --- projections and cleaning -------------------------------------------------

@query("require_columns", S.with_(S.ARTICLES) + "SELECT count(*) AS n_rows FROM articles")
def require_columns(spark, sf):
    return C.require_columns(I.articles(spark, sf), FeatureConfig(include_subject=True)).agg(
        F.count("*").alias("n_rows"))


@query("fill_missing", S.with_(S.ARTICLES) + """SELECT doc_id, CASE WHEN lang = 'en' THEN title ELSE '' END AS title, text, subject FROM articles""")
def fill_missing(spark, sf):
    gaps = I.articles(spark, sf).withColumn("title", F.when(F.col("lang") == "en", F.col("title")))
    return C.fill_missing(gaps).select("doc_id", "title", "text", "subject")


@query("drop_leaky_columns", S.with_(S.ARTICLES) + "SELECT doc_id, title, text, subject, lang FROM articles")
def drop_leaky_columns(spark, sf):
    return C.drop_leaky_columns(I.articles(spark, sf))


@query("build_content", S.with_(S.ARTICLES) + f"SELECT doc_id, {S.CONTENT} AS content FROM articles")
def build_content(spark, sf):
    return I.articles(spark, sf).select("doc_id", T.build_content(F.col("title"), F.col("text")).alias("content"))


@query("lowercase", "SELECT doc_id, lower(text) AS text FROM documents")
def lowercase(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))


def _url_sql(column, table, key):
    return f"SELECT {key}, regexp_replace({column}, {S.quoted(S.URL_EMAIL)}, ' ', 'gi') AS text FROM {table}"


@query("strip_urls_emails", _url_sql("text", "documents", "doc_id"))
def strip_urls_emails(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", T.strip_urls_emails(F.col("text")).alias("text"))


@query("strip_urls_pages", _url_sql("url || ' ' || html", "pages", "page_id"))
def strip_urls_pages(spark, sf):
    both = F.concat_ws(" ", "url", "html")
    return I.table(spark, sf, "pages").select("page_id", T.strip_urls_emails(both).alias("text"))


@query("normalize_whitespace", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents")
def normalize_whitespace(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", T.normalize_whitespace(F.col("text")).alias("text"))


@query("prepare_corpus", W_CORPUS + "SELECT doc_id, label, content FROM corpus")
def prepare_corpus(spark, sf):
    return I.corpus(spark, sf).select("doc_id", "label", "content")


@query("drop_empty", W_ALL + "SELECT doc_id FROM contents WHERE length(content) > 0")
def drop_empty(spark, sf):
    return C.drop_empty(I.all_contents(spark, sf)).select("doc_id")


@query("clean_for_inference", W_ALL + "SELECT doc_id, content FROM contents")
def clean_for_inference(spark, sf):
    return I.all_contents(spark, sf)


@query("has_url", f"SELECT page_id, regexp_matches(url || ' ' || html, {S.quoted(S.URL)}) AS has_url FROM pages")
def has_url(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", T.has_url(F.concat_ws(" ", "url", "html")).alias("has_url"))


@query("has_email", f"SELECT doc_id, regexp_matches(text, {S.quoted(S.EMAIL)}) AS has_email FROM documents")
def has_email(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", T.has_email(F.col("text")).alias("has_email"))


@query("class_name", W_LABELLED + """SELECT doc_id, CASE WHEN label = 1 THEN 'Real News' ELSE 'Fake News' END AS class_name FROM labelled""")
def class_names(spark, sf):
    return I.labelled(spark, sf).select("doc_id", class_name(F.col("label")).alias("class_name"))


@query("paired_length_check", "SELECT count(*) AS n_rows, count(*) FILTER (text IS NULL) AS n_unpaired FROM documents")
def paired_length_check(spark, sf):
    unpaired = F.col("title").isNull() | F.col("text").isNull()
    return I.articles(spark, sf).agg(F.count("*").alias("n_rows"), F.count(F.when(unpaired, 1)).alias("n_unpaired"))


@query("preview", "SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS text FROM documents")
def preview(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", T.preview(F.col("text")).alias("text"))


@query("word_count", W_ALL + "SELECT doc_id, CAST(len(regexp_extract_all(content, '\\S+')) AS BIGINT) AS words FROM contents")
def word_count(spark, sf):
    return P.with_length(I.all_contents(spark, sf)).select("doc_id", F.col("words").cast("long").alias("words"))


@query("strip_accents", W_ALL + f"SELECT doc_id, {S.folded('content')} AS content FROM contents")
def accents(spark, sf):
    return I.all_contents(spark, sf).select("doc_id", strip_accents(F.col("content"), "unicode").alias("content"))


@query("strip_accents_full", W_ALL + f"SELECT doc_id, {S.folded('content')} AS content FROM contents")
def accents_full(spark, sf):
    return I.all_contents(spark, sf).select("doc_id", strip_accents(F.col("content"), "unicode_full").alias("content"))


# --- sets ---------------------------------------------------------------------

@query("union_classes", W_LABELLED + "SELECT doc_id, label FROM labelled")
def union_classes(spark, sf):
    both = I.labelled(spark, sf).select("doc_id", "label")
    parts = [both.where(F.col("label") == c).drop("label") for c in (0, 1)]
    return C.union_classes(*parts)


@query("dedup_exact_first", S.with_(*S.ALL_CONTENTS, S.dedup("contents", "kept", order="doc_id"))
       + "SELECT doc_id, content FROM kept")
def dedup_exact_first(spark, sf):
    return I.deduplicated(spark, sf).select("doc_id", "content")


@query("dedup_with_subject", S.with_(S.ARTICLES, S.LABELLED, S.cleaned(), S.dedup(keys="content, subject"))
       + "SELECT doc_id, label, subject FROM corpus")
def dedup_with_subject(spark, sf):
    return I.corpus(spark, sf, FeatureConfig(include_subject=True)).select("doc_id", "label", "subject")


@query("distinct_labels", "SELECT DISTINCT CAST(quality AS INTEGER) AS label, quality IN (0, 1) AS valid FROM labels")
def labels_check(spark, sf):
    return distinct_labels(I.table(spark, sf, "labels").select(F.col("quality").cast("int").alias("label")))


@query("split_overlap", S.with_(*S.CORPUS, *S.split()) + """SELECT count(*) AS n_shared FROM
(SELECT content FROM train INTERSECT SELECT content FROM test)""")
def split_overlap(spark, sf):
    return C.split_overlap(I.split_corpus(spark, sf))


# --- profile ------------------------------------------------------------------

@query("class_counts", W_CORPUS + """SELECT count(*) FILTER (label = 0) AS fake_0,
count(*) FILTER (label = 1) AS real_1 FROM corpus""")
def class_counts(spark, sf):
    return P.class_counts(I.corpus(spark, sf))


@query("class_ratios", W_CORPUS + """SELECT label, count(*) AS n,
round(count(*) / (SELECT count(*) FROM corpus)::DOUBLE, 6) AS ratio FROM corpus GROUP BY label""")
def class_ratios(spark, sf):
    return rounded(P.class_ratios(I.corpus(spark, sf)))


@query("imbalance_verdict", W_CORPUS + """, c AS (SELECT count(*) FILTER (label = 0) AS fake_0,
count(*) FILTER (label = 1) AS real_1 FROM corpus), p AS (SELECT *, fake_0 + real_1 AS total,
100.0::DOUBLE * fake_0 / (fake_0 + real_1) AS fp, 100.0::DOUBLE * real_1 / (fake_0 + real_1) AS rp FROM c)
SELECT fake_0, real_1, total, round(fp, 6) AS fake_percent, round(rp, 6) AS real_percent,
CASE WHEN fake_0 = real_1 THEN 'Perfectly Balanced' WHEN abs(fp - rp) < 10 THEN 'Roughly Balanced'
ELSE 'Imbalanced' END AS verdict FROM p""")
def imbalance_verdict(spark, sf):
    return rounded(P.imbalance_verdict(I.corpus(spark, sf)))


LENGTHS = "lens AS (SELECT label, doc_id, len(regexp_extract_all(content, '\\S+')) AS words FROM corpus)"
STATS_SQL = """round(avg(words), 6) AS mean_words, round(median(words)::DOUBLE, 6) AS median_words,
CAST(min(words) AS BIGINT) AS min_words, CAST(max(words) AS BIGINT) AS max_words"""


@query("text_report", S.with_(*S.CORPUS, LENGTHS, f"s AS (SELECT {STATS_SQL} FROM lens)") + """SELECT unnest(['=== Document Length Distribution ===',
'mean_words: ' || mean_words, 'median_words: ' || median_words, 'min_words: ' || min_words, 'max_words: ' || max_words]) AS value FROM s""")
def text_report(spark, sf):
    path = scratch_path(spark, "report")
    K.text_report(K.summary_lines(rounded(P.length_stats(I.corpus(spark, sf))), "Document Length Distribution"), path)
    return spark.read.text(path)


@query("length_stats", S.with_(*S.CORPUS, LENGTHS) + f"SELECT {STATS_SQL} FROM lens")
def length_stats(spark, sf):
    return rounded(P.length_stats(I.corpus(spark, sf)))


@query("length_stats_by_class", S.with_(*S.CORPUS, LENGTHS) + f"SELECT label, {STATS_SQL} FROM lens GROUP BY label")
def length_stats_by_class(spark, sf):
    return rounded(P.length_stats(I.corpus(spark, sf), "label"))


def bins_sql(source, value, n, by=""):
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    counted = f"""SELECT {keys}bin, count(*) AS n FROM (SELECT {keys}CASE WHEN hi = lo THEN {n // 2 + 1} ELSE
CAST(least(floor(({value} - lo) / (hi - lo)::DOUBLE * {n}) + 1, {n}) AS BIGINT) END AS bin FROM
(SELECT *, min({value}) OVER ({part}) AS lo, max({value}) OVER ({part}) AS hi FROM {source})) GROUP BY ALL"""
    every = f"SELECT * FROM (SELECT DISTINCT {by} FROM {source}), range(1, {n + 1}) r(bin)" if by else f"SELECT range AS bin FROM range(1, {n + 1})"
    return f"SELECT {keys}bin, coalesce(n, 0) AS n FROM ({every}) LEFT JOIN ({counted}) USING ({keys}bin)"


@query("length_histogram", S.with_(*S.CORPUS, LENGTHS) + bins_sql("lens", "words", 60))
def length_histogram(spark, sf):
    return P.length_histogram(I.corpus(spark, sf))


@query("length_histogram_by_class", S.with_(*S.CORPUS, LENGTHS) + bins_sql("lens", "words", 60, "label"))
def length_histogram_by_class(spark, sf):
    return P.length_histogram(I.corpus(spark, sf), by="label")


RICHNESS_CAP = 5000
RICH = [*S.CORPUS, *S.postings("corpus", n_max=1, accents=False),
        f"top_posts AS (SELECT term FROM (SELECT term, sum(tf) AS cf FROM posts GROUP BY term) ORDER BY cf DESC, term LIMIT {RICHNESS_CAP})",
        "rich AS (SELECT c.doc_id, count(t.term) AS unique_tokens FROM corpus c LEFT JOIN "
        "(SELECT doc_id, term FROM posts SEMI JOIN top_posts USING (term)) t USING (doc_id) GROUP BY c.doc_id)"]


@query("vocab_richness", S.with_(*RICH) + """SELECT round(avg(unique_tokens), 6) AS mean_unique,
round(median(unique_tokens)::DOUBLE, 6) AS median_unique, min(unique_tokens) AS min_unique, max(unique_tokens) AS max_unique FROM rich""")
def vocab_richness(spark, sf):
    return rounded(P.vocab_richness_stats(I.corpus(spark, sf), RICHNESS_CAP))


@query("vocab_richness_by_doc", S.with_(*RICH) + "SELECT doc_id, unique_tokens FROM rich")
def vocab_richness_by_doc(spark, sf):
    return P.vocab_richness(I.corpus(spark, sf), RICHNESS_CAP)


def _leak_sql():
    def one(stage, source, expr):
        return f"""SELECT '{stage}' AS stage,
round(100 * avg(CAST(regexp_matches({expr}, {S.quoted(S.URL)}) AS DOUBLE)), 6) AS pct_url,
round(100 * avg(CAST(regexp_matches({expr}, {S.quoted(S.EMAIL)}) AS DOUBLE)), 6) AS pct_email FROM {source}"""
    return W_CORPUS + one("raw", "labelled", S.CONTENT) + " UNION ALL " + one("cleaned", "corpus", "content")


@query("leakage_rates", _leak_sql())
def leakage_rates(spark, sf):
    return rounded(P.leakage_rates(I.labelled(spark, sf), I.corpus(spark, sf)))


@query("leakage_rates_pages", f"""WITH p AS (SELECT url || ' ' || html AS content, {S.clean("url || ' ' || html")} AS cleaned FROM pages)
SELECT stage, round(100 * avg(CAST(regexp_matches(c, {S.quoted(S.URL)}) AS DOUBLE)), 6) AS pct_url,
round(100 * avg(CAST(regexp_matches(c, {S.quoted(S.EMAIL)}) AS DOUBLE)), 6) AS pct_email
FROM (SELECT 'raw' AS stage, content AS c FROM p UNION ALL SELECT 'cleaned', cleaned FROM p) GROUP BY stage""")
def leakage_rates_pages(spark, sf):
    raw = I.table(spark, sf, "pages").select(F.col("url").alias("title"), F.col("html").alias("text"))
    return rounded(P.leakage_rates(raw, C.clean_frame(raw)))


GROWTH_CAP = 10000


@query("ngram_growth", S.with_(*S.CORPUS, S.tokens("corpus"), S.grams(n_max=3)) + " UNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS ngram_max, CAST(least(count(DISTINCT term), {GROWTH_CAP}) AS BIGINT) AS n_features "
    f"FROM grams WHERE len(string_split(term, ' ')) <= {n}" for n in (1, 2, 3)))
def ngram_growth(spark, sf):
    return X.ngram_growth(I.corpus(spark, sf), cap=GROWTH_CAP)


EDA_CAP = 10000
EDA_TFIDF = [*S.CORPUS, *S.postings("corpus", extra=", label"), *S.vocab("corpus", min_df=1, max_df=1.0, cap=EDA_CAP),
             *S.tfidf(extra=", label"),
             "means AS (SELECT t.label, t.term, sum(weight) / max(n.n) AS mean_weight FROM tfidf t JOIN "
             "(SELECT label, count(*) AS n FROM corpus GROUP BY label) n ON n.label = t.label GROUP BY t.label, t.term)"]


@query("class_mean_tfidf", S.with_(*EDA_TFIDF) + "SELECT label, term, round(mean_weight, 6) AS mean_weight FROM means")
def class_mean_tfidf(spark, sf):
    return rounded(P.class_mean_weights(I.corpus(spark, sf), P.eda_config(EDA_CAP)))


RANKED = """SELECT label, term, round(mean_weight, 6) AS mean_weight,
CAST(row_number() OVER (PARTITION BY label ORDER BY round(mean_weight, 12) DESC, term) AS INTEGER) AS rank FROM means"""


@query("top_tokens_per_class", S.with_(*EDA_TFIDF) + f"SELECT * FROM ({RANKED}) WHERE rank <= 20")
def top_tokens_per_class(spark, sf):
    return rounded(P.top_tokens_per_class(I.corpus(spark, sf), config=P.eda_config(EDA_CAP)))


@query("rank_terms", S.with_(*EDA_TFIDF) + RANKED)
def rank_terms(spark, sf):
    """All terms of the fitted vocabulary ranked by mean weight in each class."""
    return rounded(P.rank_terms(P.class_mean_weights(I.corpus(spark, sf), P.eda_config(EDA_CAP))))


# --- tokens and terms -----------------------------------------------------------

@query("tokenize", S.with_(*S.ALL_CONTENTS, S.tokens("contents", stop=False)) + "SELECT doc_id, unnest(tokens) AS token FROM toks")
def tokenize(spark, sf):
    return I.all_contents(spark, sf).select("doc_id", T.tokenize(F.col("content")).alias("t")).select(
        "doc_id", F.explode_outer("t").alias("token")).where(F.col("token").isNotNull())


@query("remove_stopwords", S.with_(*S.ALL_CONTENTS, S.tokens("contents")) + "SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS kept FROM toks")
def remove_stopwords(spark, sf):
    return X.token_frame(I.all_contents(spark, sf)).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("kept"))


@query("ngrams", S.with_(*S.ALL_CONTENTS, S.tokens("contents"), S.grams()) + "SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL")
def ngrams(spark, sf):
    return X.postings(I.all_contents(spark, sf))


@query("term_stats", S.with_(*S.CORPUS, *S.postings("corpus")) + "SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM posts GROUP BY term")
def term_stats(spark, sf):
    return X.term_stats(X.postings(I.corpus(spark, sf)))


@query("top_vocab", S.with_(*S.CORPUS, *S.postings("corpus")) + """SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df
FROM posts GROUP BY term ORDER BY cf DESC, term LIMIT 2000""")
def top_vocab(spark, sf):
    return X.top_terms(X.term_stats(X.postings(I.corpus(spark, sf))), 2000)
