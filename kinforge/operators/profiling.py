"""Profiles of cleaned tables: lengths, examples, repeats, countries, scripts, suspicious symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import is_ascii, is_missing, script, suspicious
from ..schema import NORMALIZED_COLUMNS, TEXT_COLUMNS

PERCENTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
PROFILED = TEXT_COLUMNS + NORMALIZED_COLUMNS


def _tall(rows: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """column, value and the kept columns, a row for each column of each row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("")).alias("value")) for c in columns])
    return rows.select(*keep, F.inline(pairs))


def length_counts(rows: DataFrame) -> DataFrame:
    """column, length, n: how often each length occurs."""
    return _tall(rows, PROFILED).groupBy("column", F.length("value").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def length_quantiles(counts: DataFrame) -> DataFrame:
    """For each column min, max, total, number and nearest-rank quantiles of the lengths, by the counts alone."""
    window = Window.partitionBy("column").orderBy("length")
    running = counts.withColumn("below", F.sum("n").over(window)).withColumn("total", F.sum("n").over(Window.partitionBy("column")))
    reached = [F.min(F.when(F.col("below") >= F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(p))), F.col("length"))).cast("long").alias(f"p{int(p * 100)}") for p in PERCENTILES]
    return running.groupBy("column").agg(F.min("length").cast("long").alias("min_length"), F.max("length").cast("long").alias("max_length"), F.sum(F.col("length") * F.col("n")).alias("total_length"), F.sum("n").alias("n"), *reached)


def length_examples(rows: DataFrame, most: int = 5) -> DataFrame:
    """column, kind, rank, entity_id, value: the shortest non-empty and the longest values, ties by value, then id.

    Each task keeps its own best few before they meet, so no column is sorted as a whole.
    """
    tall = _tall(rows, PROFILED, "entity_id").withColumn("length", F.length("value"))
    out = []
    for kind, size, kept in (("shortest", F.col("length"), tall.where("length > 0")), ("longest", -F.col("length"), tall)):
        salted = kept.withColumn("size", size).withColumn("salt", F.pmod(F.xxhash64("entity_id"), F.lit(64)))
        near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("column", "salt").orderBy("size", "value", "entity_id"))).where(F.col("rank") <= most)
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy("size", "value", "entity_id"))).where(F.col("rank") <= most)
        out.append(ranked.select("column", F.lit(kind).alias("kind"), F.col("rank").cast("long").alias("rank"), "entity_id", "value"))
    return out[0].unionByName(out[1])


def repeats(rows: DataFrame) -> DataFrame:
    """kind, values, rows: how many normalized values occur more than once, and in how many rows."""
    name, address, country = NORMALIZED_COLUMNS
    record = F.sha2(F.concat_ws("\t", name, address, country), 256)
    keys = F.array(F.struct(F.lit("name").alias("kind"), F.col(name).alias("key")), F.struct(F.lit("address").alias("kind"), F.col(address).alias("key")), F.struct(F.lit("record").alias("kind"), record.alias("key")))
    counted = rows.select(F.inline(keys)).where("kind = 'record' or key <> ''").groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("kind").agg(F.count_if(F.col("n") > 1).alias("values"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows"))


def country_counts(rows: DataFrame) -> DataFrame:
    return rows.where("country <> ''").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def missing_counts(rows: DataFrame) -> DataFrame:
    """column, missing, empty, non_ascii."""
    value = F.col("value")
    return _tall(rows, TEXT_COLUMNS).groupBy("column").agg(F.count_if(is_missing(value)).alias("missing"), F.count_if(value == "").alias("empty"), F.count_if(~is_ascii(value)).alias("non_ascii"))


def _characters(rows: DataFrame, wanted: str, kind: Column) -> DataFrame:
    """column, kind, n over the characters that the pattern wanted takes; other characters are never exploded."""
    chars = _tall(rows, TEXT_COLUMNS).select("column", F.explode(F.regexp_extract_all("value", F.lit(f"({wanted})"), F.lit(1))).alias("char"))
    return chars.groupBy("column", "char").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", kind).where("kind is not null").groupBy("column", "kind").agg(F.sum("n").alias("n"))


def script_counts(rows: DataFrame) -> DataFrame:
    return _characters(rows, r"(?s)[^\x00-\x7F]", script(F.col("char")))


def suspicious_counts(rows: DataFrame) -> DataFrame:
    return _characters(rows, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\x{fffd}\p{Co}]", suspicious(F.col("char")))
