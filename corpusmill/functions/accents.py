"""Accent folding: NFKD without combining marks, in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


def fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@lru_cache(maxsize=None)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to, longer) over all of Unicode, from its rule.

    ``from`` and ``to`` are for ``translate``, which deletes those of ``from``
    that lie beyond ``to``; ``longer`` has the characters that fold to several,
    without Hangul syllables, which follow a formula.
    """
    swaps, drops, longer = [], [], {}
    for point in range(0xA0, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF or HANGUL_FIRST <= point <= HANGUL_LAST:
            continue
        char = chr(point)
        if not unicodedata.combining(char) and not unicodedata.decomposition(char):
            continue
        folded = fold(char)
        if folded == "":
            drops.append(char)
        elif len(folded) > 1:
            longer[char] = folded
        elif folded != char:
            swaps.append((char, folded))
    return "".join(a for a, _ in swaps) + "".join(drops), "".join(b for _, b in swaps), longer


@lru_cache(maxsize=None)
def _longer_class() -> str:
    """Regular expression of the characters that fold to several."""
    points = sorted(map(ord, fold_tables()[2]))
    runs: list[list[int]] = []
    for p in points:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    runs.append([HANGUL_FIRST, HANGUL_LAST])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]"


def _expand(text: Column) -> Column:
    """Characters that fold to several, one by one; only rare rows come here."""
    pairs = "\u0001".join(f"{a}\u0002{b}" for a, b in fold_tables()[2].items())
    longer = F.str_to_map(F.lit(pairs), F.lit("\u0001"), F.lit("\u0002"))
    lead, vowel, tail = ("".join(map(chr, range(a, a + n))) for a, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))

    def one(c: Column) -> Column:
        at = F.ascii(c) - HANGUL_FIRST
        syllable = F.concat(
            F.substring(F.lit(lead), (F.floor(at / 588) + 1).cast("int"), F.lit(1)),
            F.substring(F.lit(vowel), (F.floor(at % 588 / 28) + 1).cast("int"), F.lit(1)),
            F.when(at % 28 == 0, "").otherwise(F.substring(F.lit(tail), (at % 28).cast("int"), F.lit(1))))
        return F.when((at >= 0) & (at <= HANGUL_LAST - HANGUL_FIRST), syllable).otherwise(F.coalesce(F.try_element_at(longer, c), c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


@F.pandas_udf(StringType())
def _fold_full(texts: pd.Series) -> pd.Series:
    return texts.map(fold, na_action="ignore")


def strip_accents(text: Column, mode: str | None) -> Column:
    """``unicode``: all of NFKD without combining marks, by built-in functions.

    Rows in ASCII stay as they are; one-to-one folds are one ``translate``;
    only rows with ligatures, fractions, squared units or Hangul are taken
    apart. ``unicode_full`` gives the same through Python, for comparison.
    """
    if mode is None:
        return text
    non_ascii = text.rlike(r"[^\x00-\x7F]")
    if mode == "unicode":
        source, target, _ = fold_tables()
        whole = F.when(text.rlike(_longer_class()), _expand(text)).otherwise(text)
        return F.when(non_ascii, F.translate(whole, source, target)).otherwise(text)
    if mode == "unicode_full":
        return F.coalesce(_fold_full(F.when(non_ascii, text)), text)
    raise ValueError(f"unknown accent mode: {mode}")
