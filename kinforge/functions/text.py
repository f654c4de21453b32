"""Normalization of names, addresses and countries as column expressions.

ASCII values stay in the JVM. Only values with other characters go through one Arrow function, for NFC and case
folding, which Spark lacks.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .unicode_classes import SPACE

# Punctuation that is folded to ASCII, by its replacement.
SAFE_PUNCTUATION = {
    "'": "‘’‚‛",
    '"': "“”„‟",
    "-": "‐‑‒–—―−﹘﹣－",
    " ": "                 　﻿",
}
_FOLD = {ord(c): to for to, froms in SAFE_PUNCTUATION.items() for c in froms}


def is_ascii(value: Column) -> Column:
    return F.length(value) == F.octet_length(value)


def _fold(value: str, translate: bool) -> str:
    value = unicodedata.normalize("NFC", value)
    if translate:
        value = value.translate(_FOLD)
    return unicodedata.normalize("NFC", value.casefold())


@F.pandas_udf(StringType())
def _fold_text(values: pd.Series) -> pd.Series:
    return values.map(lambda v: _fold(v, True), na_action="ignore")


@F.pandas_udf(StringType())
def _fold_country(values: pd.Series) -> pd.Series:
    return values.map(lambda v: _fold(v, False), na_action="ignore")


def is_missing(value: Column) -> Column:
    """Null, empty, or nothing but white space, byte-order marks and zero-width spaces."""
    return F.coalesce(value, F.lit("")).rlike(rf"\A[{SPACE}\x{{feff}}\x{{200b}}]*\z")


def _normalize(value: Column, fold) -> Column:
    other = fold(F.when(~is_ascii(value), value))
    folded = F.when(is_ascii(value), F.lower(value)).otherwise(other)
    return F.when(is_missing(value), F.lit("")).otherwise(F.trim(F.regexp_replace(folded, f"[{SPACE}]+", " ")))


def normalize_text(value: Column) -> Column:
    """NFC, safe punctuation, case folding, NFC, white space to single spaces; missing values become empty."""
    return _normalize(value, _fold_text)


def normalize_country(value: Column) -> Column:
    """As normalize_text, with punctuation as it is."""
    return _normalize(value, _fold_country)


# Scripts by code point, in the order in which they are tried.
SCRIPTS = [
    ("Latin-ASCII", [(0x0, 0x7F)]),
    ("Latin-Extended", [(0x80, 0x24F), (0x1E00, 0x1EFF)]),
    ("Devanagari", [(0x900, 0x97F)]),
    ("Arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)]),
    ("Cyrillic", [(0x400, 0x4FF)]),
    ("CJK", [(0x4E00, 0x9FFF)]),
    ("Tamil", [(0xB80, 0xBFF)]),
    ("Telugu", [(0xC00, 0xC7F)]),
    ("Bengali", [(0x980, 0x9FF)]),
    ("Gurmukhi", [(0xA00, 0xA7F)]),
    ("Gujarati", [(0xA80, 0xAFF)]),
    ("Kannada", [(0xC80, 0xCFF)]),
    ("Malayalam", [(0xD00, 0xD7F)]),
    ("Greek", [(0x370, 0x3FF)]),
    ("Hebrew", [(0x590, 0x5FF)]),
]


def _in(code: Column, ranges: list[tuple[int, int]]) -> Column:
    found = F.lit(False)
    for low, high in ranges:
        found = found | code.between(low, high)
    return found


def script(char: Column) -> Column:
    """The script of a single character."""
    code, out = F.ascii(char), F.lit("Other-Unicode")
    for name, ranges in reversed(SCRIPTS):
        out = F.when(_in(code, ranges), name).otherwise(out)
    return out


def suspicious(char: Column) -> Column:
    """What is wrong with a single character, or null."""
    code = F.ascii(char)
    return (
        F.when(code == 0xFFFD, "replacement_character_ufffd")
        .when((code < 32) & ~code.isin(9, 10, 13), "ascii_control_character")
        .when(code.between(0x7F, 0x9F), "unicode_control_char")
        .when(_in(code, [(0xE000, 0xF8FF), (0xF0000, 0xFFFFD), (0x100000, 0x10FFFD)]), "private_use_or_surrogate")
    )
