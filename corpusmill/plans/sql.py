"""Shared pieces of the check queries, in DuckDB's dialect."""

from __future__ import annotations

from corpusmill.functions.stopwords import ENGLISH, as_tokens
from corpusmill.functions.text import EMAIL, TOKEN, URL, URL_EMAIL
from corpusmill.plans.inputs import EXTERNAL_SOURCES


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP = ", ".join(quoted(w) for w in as_tokens(ENGLISH, r"\w{2,}"))
OUTSIDE = ", ".join(quoted(s) for s in EXTERNAL_SOURCES)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ARTICLES = """articles AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS title,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS text,
         source AS subject, lang, CAST(doc_id AS VARCHAR) AS date FROM documents)"""

LABELLED = """labelled AS (
  SELECT a.*, CAST(l.quality AS INTEGER) AS label FROM articles a JOIN labels l USING (doc_id))"""


def clean(expr: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({expr}), {quoted(URL_EMAIL)}, ' ', 'gi'), "
            f"'\\s+', ' ', 'g'))")


CONTENT = "coalesce(title, '') || ' ' || coalesce(text, '')"


def cleaned(source: str = "labelled", name: str = "cleaned") -> str:
    label = "label, " if source != "articles" else ""
    return f"{name} AS (SELECT doc_id, {label}subject, {clean(CONTENT)} AS content FROM {source})"


def dedup(source: str = "cleaned", name: str = "corpus", keys: str = "content", order: str = "label, doc_id") -> str:
    return (f"{name} AS (SELECT * FROM {source} WHERE length(content) > 0 "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)")


CORPUS = [ARTICLES, LABELLED, cleaned(), dedup()]
ALL_CONTENTS = [ARTICLES, cleaned("articles", "contents")]


def split(source: str = "corpus", name: str = "split", test_size: float = 0.2, seed: int = 42) -> list[str]:
    """Largest remainder per class, then the first hash ranks are the test side."""
    return [
        f"{name}_n AS (SELECT label, count(*) AS n FROM {source} GROUP BY label)",
        f"{name}_t AS (SELECT label, n, sum(n) OVER () AS total, "
        f"ceil(sum(n) OVER () * {test_size}::DOUBLE)::BIGINT AS n_test FROM {name}_n)",
        f"{name}_f AS (SELECT *, (n * n_test) // total AS base, (n * n_test) % total AS part FROM {name}_t)",
        f"{name}_q AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY part DESC, label) "
        f"<= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM {name}_f)",
        f"{name} AS (SELECT c.*, CASE WHEN row_number() OVER (PARTITION BY c.label "
        f"ORDER BY md5(c.doc_id || ':{seed}')) <= q.quota THEN 'test' ELSE 'train' END AS split "
        f"FROM {source} c JOIN {name}_q q USING (label))",
        f"train AS (SELECT * FROM {name} WHERE split = 'train')",
        f"test AS (SELECT * FROM {name} WHERE split = 'test')",
    ]


def folds(source: str, name: str, k: int = 5, seed: int = 42, column: str = "fold", base: int = 0) -> str:
    """Equal runs of hash order per class."""
    rank = f"row_number() OVER (PARTITION BY label ORDER BY md5(doc_id || ':{seed}'))"
    n = "count(*) OVER (PARTITION BY label)"
    cuts = " + ".join(f"CASE WHEN {rank} > ceil({n} * {i} / {k}::DOUBLE) THEN 1 ELSE 0 END" for i in range(1, k))
    return f"{name} AS (SELECT *, CAST({cuts} + {base} AS INTEGER) AS {column} FROM {source})"


def folded(expr: str) -> str:
    """Accent folding, by DuckDB's own rule."""
    return f"strip_accents({expr})"


def tokens(source: str, name: str = "toks", accents: bool = True, extra: str = "", stop: bool = True) -> str:
    text = folded("content") if accents else "content"
    found = f"regexp_extract_all({text}, {quoted(TOKEN)})"
    if stop:
        found = f"list_filter({found}, lambda t: t NOT IN ({STOP}))"
    return f"{name} AS (SELECT doc_id{extra}, {found} AS tokens FROM {source})"


def grams(tokens_name: str = "toks", name: str = "grams", n_max: int = 2, extra: str = "") -> str:
    """One row per gram occurrence."""
    parts = ["tokens"] + [
        "list_transform(range(1, greatest(len(tokens) - {0}, 0) + 1), lambda i: array_to_string(tokens[i:i + {0}], ' '))".format(n - 1)
        for n in range(2, n_max + 1)]
    every = parts[0]
    for p in parts[1:]:
        every = f"list_concat({every}, {p})"
    return f"{name} AS (SELECT doc_id{extra}, unnest({every}) AS term FROM {tokens_name})"


def postings(source: str, prefix: str = "", n_max: int = 2, extra: str = "", accents: bool = True) -> list[str]:
    return [tokens(source, f"{prefix}toks", accents, extra), grams(f"{prefix}toks", f"{prefix}grams", n_max, extra),
            f"{prefix}posts AS (SELECT doc_id{extra}, term, count(*) AS tf FROM {prefix}grams "
            f"GROUP BY ALL)"]


def vocab(docs: str, posts: str = "posts", name: str = "vocab", min_df: int = 2, max_df: float = 0.95,
          cap: int = 20000) -> list[str]:
    return [
        f"{name}_stats AS (SELECT term, sum(tf)::BIGINT AS cf, count(*) AS df FROM {posts} GROUP BY term)",
        f"{name}_top AS (SELECT * FROM {name}_stats WHERE df >= {min_df} AND df <= {max_df}::DOUBLE * "
        f"(SELECT count(*) FROM {docs}) ORDER BY cf DESC, term LIMIT {cap})",
        f"{name} AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx, cf, df, "
        f"ln((1.0::DOUBLE + (SELECT count(*) FROM {docs})) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf FROM {name}_top)",
    ]


def tfidf(posts: str = "posts", vocab_name: str = "vocab", name: str = "tfidf", extra: str = "") -> list[str]:
    cols = "".join(f", p.{c.strip()}" for c in extra.split(",") if c.strip())
    return [
        f"{name}_raw AS (SELECT p.doc_id{cols}, p.term, v.term_idx, p.tf, (1.0::DOUBLE + ln(p.tf::DOUBLE)) * v.idf AS w "
        f"FROM {posts} p JOIN {vocab_name} v USING (term))",
        f"{name} AS (SELECT doc_id{extra}, term, term_idx, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight "
        f"FROM {name}_raw)",
    ]


# Train-side features: split, train postings, vocabulary, weights.
TRAIN_FEATURES = [*CORPUS, *split(), *postings("train", extra=", label"), *vocab("train"), *tfidf(extra=", label")]
# Test-side weights under the same vocabulary.
TEST_FEATURES = [*postings("test", "test_", extra=", label"), *tfidf("test_posts", "vocab", "test_tfidf", ", label")]

SCORED = [*CORPUS,
          "scored AS (SELECT doc_id, label, score, CAST(score >= 0.5 AS INTEGER) AS pred FROM (SELECT doc_id, label, "
          "(1000 * len(list_distinct(string_split(content, ' ')))) // len(string_split(content, ' ')) / 1000.0::DOUBLE "
          "AS score FROM corpus))"]

CONFUSION_COLUMNS = """
  count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 0) AS tn,
  count(*) FILTER (label = 0 AND pred = 1) AS fp, count(*) FILTER (label = 1 AND pred = 0) AS fn"""

BINARY_COLUMNS = """
  round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0)::DOUBLE, 0), 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS sensitivity,
  round(coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0), 6) AS specificity,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1_score"""

_N = "nullif(tp + tn + fp + fn, 0)::DOUBLE"
_P0, _R0 = "coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0)", "coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0)"
_P1, _R1 = "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)", "coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)"
_F0, _F1 = "coalesce(2 * tn / nullif(2 * tn + fp + fn, 0)::DOUBLE, 0)", "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)"


def _weighted(a: str, b: str) -> str:
    return f"({a} * (tn + fp) + {b} * (tp + fn)) / {_N}"


WEIGHTED = {
    "accuracy": f"(tp + tn) / {_N}", "precision_weighted": _weighted(_P0, _P1), "recall_weighted": _weighted(_R0, _R1),
    "specificity": _R0, "f1_weighted": _weighted(_F0, _F1)}
WEIGHTED_COLUMNS = ", ".join(f"round({e}, 6) AS {n}" for n, e in WEIGHTED.items())


def report_rows(conf: str) -> str:
    """Five report rows from a one-row confusion table."""
    def line(name, p, r, f, s):
        return (f"SELECT '{name}' AS \"row\", round({p}, 6) AS \"precision\", round({r}, 6) AS recall, "
                f"round({f}, 6) AS f1_score, CAST({s} AS BIGINT) AS support FROM {conf}")
    acc = f"(tp + tn) / {_N}"
    total = "tp + tn + fp + fn"
    return " UNION ALL ".join([
        line("class_0", _P0, _R0, _F0, "tn + fp"), line("class_1", _P1, _R1, _F1, "tp + fn"),
        line("accuracy", acc, acc, acc, total),
        line("macro_avg", f"({_P0} + {_P1}) / 2", f"({_R0} + {_R1}) / 2", f"({_F0} + {_F1}) / 2", total),
        line("weighted_avg", _weighted(_P0, _P1), _weighted(_R0, _R1), _weighted(_F0, _F1), total)])


def auc(source: str, by: str = "") -> list[str]:
    """Tie-aware area per group: one row per distinct score, running positives."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return [
        f"auc_c AS (SELECT {keys}score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg "
        f"FROM {source} GROUP BY ALL)",
        f"auc_r AS (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC) AS tp, sum(neg) OVER ({part}ORDER BY score DESC) AS fp FROM auc_c)",
        f"auc_t AS (SELECT {keys}CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(neg * (tp - pos / 2.0::DOUBLE)) / "
        f"(sum(pos) * sum(neg))::DOUBLE ELSE 0.5::DOUBLE END AS auc_roc FROM auc_r{group})",
    ]


# Naive Bayes weights over the training side; n0, n1, t0, t1, v as columns.
NB_SUMS = [
    "nb_sums AS (SELECT v.term_idx, coalesce(sum(weight) FILTER (label = 0), 0)::DOUBLE AS f0, "
    "coalesce(sum(weight) FILTER (label = 1), 0)::DOUBLE AS f1, count(weight) FILTER (label = 0) AS d0, "
    "count(weight) FILTER (label = 1) AS d1 FROM vocab v LEFT JOIN tfidf t USING (term_idx) GROUP BY v.term_idx)",
    "nb_n AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM train)",
    "nb_full AS (SELECT s.*, n.n0, n.n1, sum(f0) OVER () AS t0, sum(f1) OVER () AS t1, count(*) OVER () AS v "
    "FROM nb_sums s, nb_n n)",
]


def nb_weight(kind: str, a: str) -> str:
    if kind == "BNB":
        p0, p1 = f"((d0 + {a}) / (n0 + 2 * {a}))", f"((d1 + {a}) / (n1 + 2 * {a}))"
        return f"ln({p1} / (1 - {p1})) - ln({p0} / (1 - {p0}))"
    return f"ln((f1 + {a}) / (t1 + {a} * v)) - ln((f0 + {a}) / (t0 + {a} * v))"


def nb_absent(kind: str, a: str) -> str:
    if kind != "BNB":
        return "0.0::DOUBLE"
    return f"ln(1 - (d1 + {a}) / (n1 + 2 * {a})) - ln(1 - (d0 + {a}) / (n0 + 2 * {a}))"


def nb_prior(kind: str) -> str:
    return "0.0::DOUBLE" if kind == "CNB" else "ln(n1 / n0::DOUBLE)"


def nb_model(kind: str, alpha: float, name: str = "nb") -> list[str]:
    a = f"{alpha}::DOUBLE"
    return [f"{name}_w AS (SELECT term_idx, {nb_weight(kind, a)} AS w FROM nb_full)",
            f"{name}_b AS (SELECT sum({nb_absent(kind, a)}) + max({nb_prior(kind)}) AS b FROM nb_full)"]


def nb_scores(kind: str, docs: str, weights: str, name: str = "nb", out: str = "nb_scored", keep: str = ", label") -> list[str]:
    x = "1.0::DOUBLE" if kind == "BNB" else "weight"
    cols = "".join(f", d.{c.strip()}" for c in keep.split(",") if c.strip())
    return [
        f"{out}_d AS (SELECT doc_id, sum({x} * w) AS dot FROM {weights} JOIN {name}_w USING (term_idx) GROUP BY doc_id)",
        f"{out} AS (SELECT d.doc_id{cols}, coalesce(s.dot, 0) + b.b AS margin, "
        f"1 / (1 + exp(-greatest(-500, least(500, coalesce(s.dot, 0) + b.b)))) AS score, "
        f"CAST(coalesce(s.dot, 0) + b.b > 0 AS INTEGER) AS pred FROM {docs} d LEFT JOIN {out}_d s USING (doc_id), {name}_b b)"]
