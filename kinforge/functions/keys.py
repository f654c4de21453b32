"""Blocking keys of normalized names and addresses, as array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ADDRESS_STOPLIST, LEGAL_STOPLIST, STRUCTURAL_NOISE
from .unicode_classes import decimal, digit, letter_or_number, word


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once however often body's lambdas use it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def tokens(text: Column) -> Column:
    """Maximal runs of letters, numbers, marks and underscores."""
    return F.regexp_extract_all(text, F.lit(f"([{word()}]+)"), F.lit(1))


def name_tokens(name: Column, stoplist: list[str] = LEGAL_STOPLIST, min_length: int = 2) -> Column:
    return F.filter(tokens(name), lambda t: (F.length(t) >= min_length) & ~F.array_contains(_literal(stoplist), t))


def address_tokens(address: Column, stoplist: list[str] | None = ADDRESS_STOPLIST, min_length: int = 2) -> Column:
    found = F.filter(tokens(address), lambda t: (F.length(t) >= min_length) & ~t.rlike(f"^[{digit()}]+$"))
    return F.filter(found, lambda t: ~F.array_contains(_literal(stoplist), t)) if stoplist else found


def address_numbers(address: Column) -> Column:
    return F.regexp_extract_all(address, F.lit(f"([{decimal()}]+)"), F.lit(1))


def number_location_keys(address: Column, min_length: int = 2, most_tokens: int = 10) -> Column:
    """Each number with each of the first telling tokens, as ``number:token``, in order, without repeats."""
    plain = address_tokens(address, None, min_length)
    noise = lambda t: F.array_contains(_literal(STRUCTURAL_NOISE), t)
    # all tokens where none is telling; tokens are cut once, and noise is told by sorting it out of one array
    telling = F.aggregate(
        plain,
        F.struct(F.expr("cast(array() as array<string>)").alias("told"), F.expr("cast(array() as array<string>)").alias("rest")),
        lambda s, t: F.struct(F.when(noise(t), s["told"]).otherwise(F.concat(s["told"], F.array(t))).alias("told"), F.when(noise(t), F.concat(s["rest"], F.array(t))).otherwise(s["rest"]).alias("rest")),
        lambda s: F.slice(F.when(F.size(s["told"]) > 0, s["told"]).otherwise(s["rest"]), 1, most_tokens),
    )
    pairs = _let(telling, lambda told: F.flatten(F.transform(address_numbers(address), lambda n: F.transform(told, lambda t: F.concat_ws(":", n, t)))))
    return F.array_distinct(pairs)


def compact_ngrams(name: Column, n: int = 4, min_length: int = 3) -> Column:
    """Character n-grams of the name without anything but letters, numbers and marks; a short name is one."""
    def grams(compact: Column) -> Column:
        size = F.length(compact)
        sliding = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substring(compact, i, F.lit(n)))
        return F.when(size < min_length, F.expr("cast(array() as array<string>)")).when(size < n, F.array(compact)).otherwise(sliding)

    return _let(F.array_join(F.regexp_extract_all(name, F.lit(f"([{letter_or_number()}]+)"), F.lit(1)), ""), grams)
