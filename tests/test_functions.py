import re
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from kinforge.functions import keys, unicode_classes
from kinforge.functions.text import is_missing, normalize_country, normalize_text, script, suspicious


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in rows.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("Café L'Étoile & München Bräuhaus", "café l'étoile & münchen bräuhaus"),
        ("राम मार्केटिंग प्राइवेट लिमिटेड", "राम मार्केटिंग प्राइवेट लिमिटेड"),
        ("ООО Ромашка Плюс", "ооо ромашка плюс"),
        ("Maße", "masse"),
        ("école", "école"),
        ("\t  Acme   \r\n   Logistics    LLC \t\n", "acme logistics llc"),
        ("“Bob’s” ‘Best’ „Bakery‟", "\"bob's\" 'best' \"bakery\""),
        ("A–B—C−D‐E‑F", "a-b-c-d-e-f"),
        ("a ʻ ʼ ′ ″", "a ʻ ʼ ′ ″"),
        ("Pizza Pizza Inc", "pizza pizza inc"),
        ("", ""),
        (None, ""),
        ("x​y", "x​y"),
    ],
)
def test_normalize_text(spark, raw, expected):
    assert column(spark, [raw], normalize_text) == [expected]


def test_normalize_country(spark):
    assert column(spark, ["  US  ", "", None, "﻿US", "Côte d’Ivoire"], normalize_country) == ["us", "", "", "﻿us", "côte d’ivoire"]


def test_missing(spark):
    assert column(spark, ["", "   ", "\t\r\n ", "﻿", " ", " ", " ﻿​", None], is_missing) == [True] * 8
    assert column(spark, ["US", " . ", "NAN", "Null", "None"], is_missing) == [False] * 5


def test_tokens(spark):
    assert column(spark, ["अलग शब्द", "متجر الكتب", "l'école_no 1", "தமிழ் சொல்", ""], keys.tokens) == [["अलग", "शब्द"], ["متجر", "الكتب"], ["l", "école_no", "1"], ["தமிழ்", "சொல்"], []]
    assert column(spark, ["acme trading inc x"], keys.name_tokens) == [["acme", "trading"]]
    assert column(spark, ["12 main st suite 5 ② austin"], keys.address_tokens) == [["main", "austin"]]
    assert column(spark, ["g3 12, 12 ४५"], keys.address_numbers) == [["3", "12", "12", "४५"]]


def test_number_location_keys(spark):
    assert column(spark, ["100 main st, austin", "no 5 suite", "main st", "5 5 elm"], keys.number_location_keys) == [["100:main", "100:st", "100:austin"], ["5:no", "5:suite"], [], ["5:elm"]]
    many = "7 " + " ".join(f"t{c}t" for c in "abcdefghijklm")
    assert len(column(spark, [many], keys.number_location_keys)[0]) == 10


def test_ngrams(spark):
    assert column(spark, ["ab", "abc", "abcd", "a b-c_de f", ""], keys.compact_ngrams) == [[], ["abc"], ["abcd"], ["abcd", "bcde", "cdef"], []]


def test_classes_agree_with_python(spark):
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    rows = spark.createDataFrame([(c,) for c in points], "c string").select("c", F.col("c").rlike(f"^[{unicode_classes.word()}]$").alias("word"), F.col("c").rlike(f"^[{unicode_classes.decimal()}]$").alias("decimal"), F.col("c").rlike(f"^[{unicode_classes.digit()}]$").alias("digit"), F.col("c").rlike(rf"\A[{unicode_classes.SPACE}]\z").alias("space"))
    wrong = []
    for r in rows.toLocalIterator():
        c = r["c"]
        expected = (c == "_" or unicodedata.category(c)[0] in "LNM", unicodedata.category(c) == "Nd", c.isdigit(), re.fullmatch(r"\s", c) is not None)
        if expected != (r["word"], r["decimal"], r["digit"], r["space"]) and c != "\n":
            wrong.append(hex(ord(c)))
    assert wrong == []


def test_scripts_and_symbols(spark):
    assert column(spark, ["a", "é", "ḁ", "अ", "ع", "Ж", "中", "த", "త", "অ", "ਅ", "અ", "ಅ", "അ", "α", "א", "😀"], script) == [
        "Latin-ASCII", "Latin-Extended", "Latin-Extended", "Devanagari", "Arabic", "Cyrillic", "CJK", "Tamil", "Telugu", "Bengali", "Gurmukhi", "Gujarati", "Kannada", "Malayalam", "Greek", "Hebrew", "Other-Unicode",
    ]
    assert column(spark, ["\ufffd", "\x01", "\t", "\x7f", "\x85", "\ue000", "a"], suspicious) == ["replacement_character_ufffd", "ascii_control_character", None, "unicode_control_char", "unicode_control_char", "private_use_or_surrogate", None]
