"""Text expressions.  All but ``fold_exact`` and ``similarity`` stay inside codegen."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from . import as_col



def _bases() -> tuple[str, str]:
    """Characters that are a base and marks in their decomposition, of any script, with their bases; then lone marks, which have none."""
    letters, bases, marks = [], [], []
    for k in range(0xC0, 0x10000):
        c = chr(k)
        if 0xD800 <= k < 0xE000:  # half characters
            continue
        first, *rest = unicodedata.normalize("NFD", c)
        if all(map(unicodedata.combining, (first, *rest))):
            marks.append(c)
        elif rest and all(map(unicodedata.combining, rest)):
            letters.append(c)
            bases.append(unicodedata.normalize("NFKD", first)[0])
    return "".join(letters + marks), "".join(bases)


ACCENTED, PLAIN = _bases()


def strip_accents(c) -> Column:
    """Letters of any script to their base letters, marks dropped; texts of plain letters skip the lookup."""
    x = as_col(c)
    return F.when(F.octet_length(x) == F.char_length(x), x).otherwise(F.translate(x, ACCENTED, PLAIN))


def normalize_text(c) -> Column:
    """Accents off, upper case, white space collapsed and trimmed; null gives ''."""
    x = F.coalesce(as_col(c).cast("string"), F.lit(""))
    # One word without white space, as most codes and dates are, needs no expression engine.
    return F.when(x.rlike(r"\s"), F.trim(F.regexp_replace(F.upper(strip_accents(x)), r"\s+", " "))).otherwise(F.upper(strip_accents(x)))


def fold(c) -> Column:
    """Accents off, lower case: the form that searches compare."""
    return F.lower(strip_accents(F.coalesce(as_col(c).cast("string"), F.lit(""))))


def name_ascii(c) -> Column:
    """Upper-case letters and digits, everything else one space."""
    return F.trim(F.regexp_replace(normalize_text(c), "[^A-Z0-9]+", " "))


def name_key(c) -> Column:
    """Company names in a canonical form: legal forms abbreviated, a leading conjunction dropped."""
    x = F.regexp_replace(normalize_text(c), "[^A-Z0-9 ]+", " ")
    for long, short in ((r"\bSOCIEDAD ANONIMA\b", " SA "), (r"\bLIMITADA\b", " LTDA "), (r"\bE I R L\b", " EIRL "), (r"\bS P A\b", " SPA ")):
        x = F.regexp_replace(x, long, short)
    x = F.trim(F.regexp_replace(x, r"\s+", " "))
    return F.regexp_replace(x, r"^(Y|E)\s+(?=[A-Z0-9])", "")


def token_jaccard(a, b) -> Column:
    """Shared words over all words of two texts; 0 if either has none."""
    words = lambda c: F.array_remove(F.array_distinct(F.split(as_col(c), " ")), "")
    x, y = words(a), words(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def region_agrees(a, b) -> Column:
    """True or false if either name holds the other; null if one is blank."""
    x, y = name_key(a), name_key(b)
    return F.when((x != "") & (y != ""), F.contains(y, x) | F.contains(x, y))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two texts, which no built-in gives."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


# All that a company name's key is made of.
NAME_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "


def ratio_bound(a, b) -> Column:
    """Never below the matching-blocks ratio of two keys: twice the letters that they share over all letters, as blocks share no letter twice."""
    x, y = as_col(a), as_col(b)
    held = lambda c, letter: F.length(c) - F.length(F.replace(c, letter, F.lit("")))
    common = F.aggregate(F.array(*map(F.lit, NAME_LETTERS)), F.lit(0), lambda n, letter: n + F.least(held(x, letter), held(y, letter)))
    return F.when(F.length(x) + F.length(y) == 0, 1.0).otherwise(2.0 * common / (F.length(x) + F.length(y)))


def similarity(a, b) -> Column:
    """1 for equal names, 0 if one is blank, else ratio and shared words weighted 65 to 35."""
    x, y = as_col(a), as_col(b)
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).otherwise(0.65 * sequence_ratio(x, y) + 0.35 * token_jaccard(x, y))


@F.pandas_udf(StringType())
def fold_exact(c: pd.Series) -> pd.Series:
    """Full compatibility decomposition, for scripts beyond Latin; upper case, white space collapsed."""

    def one(x):
        decomposed = unicodedata.normalize("NFKD", x or "")
        return " ".join("".join(ch for ch in decomposed if not unicodedata.combining(ch)).upper().split())

    return c.map(one)


def money_int(c) -> Column:
    """The digits of a text as a number; null if there are none."""
    return F.expr("try_cast(nullif(regexp_replace({0}, '[^0-9]', ''), '') as bigint)".format(as_name(c)))


def as_name(c: str) -> str:
    return f"`{c}`" if c.isidentifier() else c


def money_short(c) -> Column:
    """Amounts for people: thousands of millions, millions, thousands."""
    x = as_col(c)
    size = F.abs(x)
    return (
        F.when(x.isNull(), "-")
        .when(size >= 1e9, F.concat(F.format_number(x / 1e9, 1), F.lit(" B")))
        .when(size >= 1e6, F.concat(F.format_number(x / 1e6, 1), F.lit(" M")))
        .when(size >= 1e3, F.concat(F.format_number(x / 1e3, 1), F.lit(" K")))
        .otherwise(F.format_number(x, 0))
    )


def shorten(c, n: int) -> Column:
    """At most n letters, the last an ellipsis if some are cut."""
    x = F.coalesce(as_col(c), F.lit(""))
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n - 1), F.lit("…"))).otherwise(x)


def finite(c) -> Column:
    """Null for NaN and infinities, which strict JSON can't hold."""
    x = as_col(c)
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def strict_json(c) -> Column:
    """JSON text with bare NaN and Infinity tokens outside strings turned to null."""
    tokens = r'("(?:[^"\\]|\\.)*")|-?\bInfinity\b|\bNaN\b'
    marked = F.regexp_replace(as_col(c), tokens, "$1\u0001")
    return F.regexp_replace(F.regexp_replace(marked, '("(?:[^"\\\\]|\\\\.)*")\u0001', "$1"), "\u0001", "null")
