"""Text expressions: Column in, Column out, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusmill.config import FeatureConfig
from corpusmill.functions.accents import strip_accents
from corpusmill.functions.stopwords import word_list

# The patterns the results depend on.
URL_EMAIL = r"\b((?:https?://|www\.)\S+|[\w\.-]+@[\w\.-]+\.\w+)\b"
URL = r"https?://|www\."
EMAIL = r"[\w\.-]+@[\w\.-]+\.\w+"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def build_content(title: Column, text: Column) -> Column:
    blank = F.lit("")
    return F.concat(F.coalesce(title, blank), F.lit(" "), F.coalesce(text, blank))


def strip_urls_emails(text: Column) -> Column:
    """Only texts with a part that every match needs go through the pattern, which tries each run of word characters."""
    needed = text.contains("@") | text.contains("://") | F.lower(text).contains("www.")
    return F.when(needed, F.regexp_replace(text, F.lit("(?iU)" + URL_EMAIL), F.lit(" "))).otherwise(text)


def normalize_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, F.lit(r"(?U)\s+"), F.lit(" ")))


def clean_text(text: Column, config: FeatureConfig = FeatureConfig()) -> Column:
    """Lower-case, then drop links and addresses, then collapse white space."""
    if config.lowercase:
        text = F.lower(text)
    if config.remove_urls_emails:
        text = strip_urls_emails(text)
    if config.normalize_whitespace:
        text = normalize_whitespace(text)
    return text


def has_url(text: Column) -> Column:
    return text.rlike(URL)


def has_email(text: Column) -> Column:
    return text.rlike("(?U)" + EMAIL)


def word_count(text: Column) -> Column:
    """Runs of non-space characters; 0 for an empty text."""
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def preview(text: Column, width: int = 200) -> Column:
    cut = F.concat(F.substring(text, 1, width), F.lit("..."))
    return F.when(F.length(text) > width, cut).otherwise(text)


def tokenize(text: Column, accents: str | None = "unicode") -> Column:
    return F.regexp_extract_all(strip_accents(text, accents), F.lit(TOKEN), F.lit(0))


def remove_stopwords(tokens: Column, stop_words: str | None = "english") -> Column:
    words = word_list(stop_words, r"\w{2,}")
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))


def _joined(tokens: Column, n: int):
    return lambda t, i: F.concat_ws(" ", t, *[F.get(tokens, i + k) for k in range(1, n)])


def ngrams(tokens: Column, n_min: int, n_max: int) -> Column:
    """Word n-grams of every size; give ``tokens`` as a plain column."""
    parts = []
    for n in range(n_min, n_max + 1):
        starts = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
        parts.append(tokens if n == 1 else F.transform(starts, _joined(tokens, n)))
    return parts[0] if len(parts) == 1 else F.concat(*parts)
