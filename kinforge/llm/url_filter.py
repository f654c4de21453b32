"""URL filters by a bit-parallel wildcard automaton.

A rule is a host glob, a path glob and a verdict: ``*`` stands for any run of characters and ``?`` for one character
of its own part (a star of the host never reaches into the path). A rule fits the hosts and all their subdomains
where the path starts with the path's glob; as one glob over ``.host/path`` it is ``*.host`` path ``*``. All globs
are packed side by side into words of 64 bits, one bit for each of their characters. For a block of URLs the state
is a matrix (URLs x words); each character moves all patterns of all URLs at once:
``D = (((D << 1) | first) & accept[c]) | (D & stay[c])``, where stay holds the places of stars, for the bytes of
their part, and the places of ended patterns, for every byte.

Of the rules that fit the longest wins (by the characters of its globs), at equal lengths the first. Where no rule
fits, the same automaton's ``fallback`` globs decide likewise, by default ``FALLBACK``: hosts with a label that names
gambling, adult content, advertising, spam or counterfeit drugs are blocked; all others get ``default``.

Defined results: host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered;
path is what follows up to ``?``, ``#`` or the end; both are empty for null or no ``://``, and no rule with a host
fits them. Without a fitting rule ``rule`` is null. Whole URLs are read, however long; rows that repeat are judged
alike; an empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .arrow_text import map_texts, whole_row

#: URLs of a block, and code units of one URL that the automaton takes at a time.
BLOCK = 4096
#: Stands between host and path, so that a rule's host never matches inside a path.
SLASH_OF_PATH = 0


#: Words that, at the start of a host's label, tell what a corpus of text does without.
BLOCKED_LABELS = "adserver ads adult bet bets betting casino cheap-pills escort free-bets gambling lottery malware phishing pills poker porn replica-watches sex-cam slots spam sportsbook torrent tracker viagra warez webcam-girls xxx".split()


def label_globs(words: list[str]) -> list[tuple[str, str, str]]:
    """Rules that block hosts with a label that is a word, or starts with it and a hyphen."""
    return [(glob, "", "block") for w in words for glob in (f"{w}.*", f"{w}-*")]


FALLBACK = label_globs(BLOCKED_LABELS)


def _elements(host: str, path: str) -> list[tuple[str, str | int]]:
    """What a rule is made of, in order: ("byte", value), ("one", "") or ("star", part)."""
    out: list[tuple[str, str | int]] = [("star", "host"), ("byte", ord("."))]
    for part, glob in (("host", host.lower()), ("path", path)):
        for c in glob:
            out += [("star", part)] if c == "*" else [("one", part)] if c == "?" else [("byte", b) for b in c.encode()]
        out += [("byte", SLASH_OF_PATH)] if part == "host" else [("star", "path")]
    return out


class ShiftAnd:
    """All rules as one automaton over bytes: b'.' + host, the byte SLASH_OF_PATH, path."""

    def __init__(self, rules: list[tuple[str, str]]):
        globs = [_elements(host, path) for host, path in rules]
        bits = sum(1 + sum(kind != "star" for kind, _ in g) for g in globs)
        self.words = max(1, -(-bits // 64))
        accept = np.zeros((256, self.words * 64), dtype=bool)
        stay = np.zeros_like(accept)
        first = np.zeros((1, self.words * 64), dtype=bool)
        self.finals: list[int] = []
        at = 0
        for glob in globs:
            first[0, at] = True
            for kind, value in glob:
                if kind == "star":  # what stands before the star holds on
                    stay[:, at] = True
                    stay[SLASH_OF_PATH, at] = stay[SLASH_OF_PATH, at] and value == "path"
                    continue
                at += 1
                if kind == "byte":
                    accept[value, at] = True
                else:  # one character: its first byte, and those that continue it
                    accept[:0x80, at] = accept[0xC0:, at] = True
                    accept[SLASH_OF_PATH, at] = False
                    stay[0x80:0xC0, at] = True
            self.finals.append(at)
            at += 1
        self.accept, self.stay, self.start = (self._pack(x) for x in (accept, stay, first))
        self.start = self.start[0]

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8")

    def fits(self, texts: list[bytes]) -> np.ndarray:
        """Rows of booleans, one for each rule."""
        n = len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, n)
        out = np.zeros((n, self.words), dtype=np.uint64)
        order = np.argsort(-lengths, kind="stable")  # the rows that have ended are always the last ones
        flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        state = np.tile(self.start, (n, 1))
        alive = np.searchsorted(-lengths, -np.arange(lengths[0] + 1 if n else 1), side="left")
        one, top = np.uint64(1), np.uint64(63)
        for k in range(int(lengths[0]) if n else 0):
            m = alive[k]
            c = flat[begin[:m] + k]
            d = state[:m]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:m] = moved & self.accept[c] | d & self.stay[c]
        out[order] = state
        finals = np.array(self.finals, dtype=np.int64)
        return (out[:, finals >> 6] >> (finals & 63).astype(np.uint64) & one).astype(bool)


def host_of(url: Column) -> Column:
    """Host and path by DataFrame functions, as the automaton's input has them."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow", carry: list[str] | None = None, fallback: list[tuple[str, str, str]] = FALLBACK) -> DataFrame:
    """``row`` (a struct of the carried columns, all by default), host, path, rule (host then path of the rule),
    verdict, and pattern (host then path of the fallback glob that decided, else null). rules and fallback: host
    glob, path glob and verdict each."""
    both = [*rules, *fallback]
    automaton = ShiftAnd([(h, p) for h, p, _ in both])
    size = lambda i: len(both[i][0]) + len(both[i][1])
    order = sorted(range(len(both)), key=lambda i: (i >= len(rules), -size(i), i))
    row = whole_row(pages.select(*[F.col(f"`{c}`") for c in carry])) if carry else whole_row(pages)
    rows = pages.select(row.alias("row"), host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"))
    rows = rows.withColumn("at", F.concat(F.lit("."), F.col("host"), F.lit("\0"), F.col("path")))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x.encode() for x in batch.column("at").to_pylist()]
        best = np.full(len(texts), -1, dtype=np.int32)
        for a in range(0, len(texts), BLOCK):
            fits = automaton.fits(texts[a : a + BLOCK])
            for i in reversed(order):
                best[a : a + BLOCK][fits[:, i]] = i
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "host", "path")), pa.array(best)], names=["row", "host", "path", "best"])

    judged = map_texts(rows, kernel, StructType([*(rows.schema[c] for c in ("row", "host", "path")), StructField("best", IntegerType())]), "at")
    table = lambda values: F.get(F.array(*[F.lit(v).cast("string") for v in values]), F.col("best")) if values else F.lit(None).cast("string")
    names = [h + p for h, p, _ in both]
    rule = table([n if i < len(rules) else None for i, n in enumerate(names)])
    pattern = table([n if i >= len(rules) else None for i, n in enumerate(names)])
    return judged.select("row", "host", "path", rule.alias("rule"), F.coalesce(table([v for *_, v in both]), F.lit(default)).alias("verdict"), pattern.alias("pattern"))
