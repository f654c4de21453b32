"""Regular-expression classes made from the running Python's Unicode tables, so that the JVM agrees with them."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache


def _ranges(holds: Callable[[str], bool]) -> str:
    """The inside of a Java character class of all code points for which holds is true."""
    out, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and not 0xD800 <= code <= 0xDFFF and holds(chr(code))
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            out.append(f"\\x{{{start:x}}}" + (f"-\\x{{{code - 1:x}}}" if code - 1 > start else ""))
            start = None
    return "".join(out)


def _class(ascii_part: str, holds: Callable[[str], bool]) -> str:
    """The inside of a class that settles ASCII before it looks at the many ranges of other characters."""
    return ascii_part + "[[^\\x00-\\x7f]&&[" + _ranges(lambda c: c > "\x7f" and holds(c)) + "]]"


@cache
def word() -> str:
    """Letters, numbers, marks and the underscore."""
    return _class("0-9A-Z_a-z", lambda c: unicodedata.category(c)[0] in "LNM")


@cache
def letter_or_number() -> str:
    """word() without the underscore."""
    return _class("0-9A-Za-z", lambda c: unicodedata.category(c)[0] in "LNM")


@cache
def decimal() -> str:
    """Decimal digits (category Nd)."""
    return _class("0-9", lambda c: unicodedata.category(c) == "Nd")


@cache
def digit() -> str:
    """What str.isdigit takes: decimal digits, superscripts, circled digits."""
    return _class("0-9", str.isdigit)


#: White space as Python's \s has it.
SPACE = r"\x1c-\x1f\p{IsWhite_Space}"
