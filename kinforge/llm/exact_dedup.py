"""Exact dedup by two passes of Bloom filtering; DataFrame functions only.

Pass 1 is a counting filter of ``CELLS`` counters, dealt out over the executors by cell: each task counts its rows by
cell, and only these counts (12 bytes or so, never a text or a row) are exchanged. Cells with two or more rows go into
a Bloom filter (``bloom``), which grows with them. Pass 2 tests each row's cell: rows that miss are the only ones of
their text and pass straight through; the others shuffle and are settled by their whole SHA-256. A fuller filter lets
more rows shuffle; it never changes the result.

Defined results: a null text counts as empty; A-Z are lower-cased, nothing else; whole texts are hashed, however long;
of equal texts the row with the largest id stays (null ids are below all others); rows that repeat both id and text
are one document in ``dedupe`` and are each marked in ``annotate``; an empty table gives an empty result; other
columns are carried as they are.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import whole_row
from .bloom import BloomFilter
from .staging import stage

#: Counters of the first pass; they are rows of a shuffled table, made only where a row falls.
CELLS = 1 << 40


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and nothing else; lower() does the same, and faster, where all characters are ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _cell(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(CELLS))


class RepeatFilter:
    """The two passes: built from digests, it marks rows."""

    def __init__(self, digests: DataFrame):
        counted = digests.groupBy(_cell(F.col("digest")).alias("key")).count()
        self.repeated = BloomFilter(stage(counted.where("count > 1").select("key"), "repeated-cells"))

    def mark(self, rows: DataFrame) -> DataFrame:
        """rows with ``maybe``: false only where no other row has the row's ``digest``."""
        return self.repeated.mark(rows, _cell(F.col("digest")))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def annotate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: id, keep_id, group_size, kept, text_sha256. The texts are read once."""
    digests = stage(docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest")), "digests")
    marked = RepeatFilter(digests).mark(digests)
    alone = marked.where(~F.col("maybe")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    rows = marked.where("maybe")
    # the substring hides how the groups are dealt out: both sides are shuffled, and a large group may be split
    groups = _groups(rows).select(F.substring("digest", 1, 64).alias("digest"), "keep_id", "group_size")
    settled = rows.join(groups, "digest").select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
    return alone.unionByName(settled).withColumnRenamed("digest", "text_sha256")


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; only possibly repeated ones shuffle."""
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest"))
    digests = stage(rows.select("id", "digest"), "digests")
    repeats = RepeatFilter(digests)
    winners = _groups(repeats.mark(digests).where("maybe")).select("digest", "keep_id")
    marked = repeats.mark(rows)
    held = marked.where("maybe")
    held = held.join(winners, (held["digest"] == winners["digest"]) & held["id"].eqNullSafe(winners["keep_id"]), "left_semi")
    return marked.where(~F.col("maybe")).select("row.*").unionByName(held.dropDuplicates(["digest", "id"]).select("row.*"))
