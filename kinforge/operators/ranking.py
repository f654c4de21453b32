"""Evidence tiers, ranks within caps, and the exported lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import PROVENANCE


def _bit(name: str) -> Column:
    return (F.col("provenance").bitwiseAND(PROVENANCE[name]) > 0).cast("int")


def evidence_tier() -> list[Column]:
    """What orders candidates, the strongest first: each value counts only where those before are equal."""
    order = ["rare_name_token", "address_number_location", "address_token", "compact_char_ngram", "missing_country_fallback", "cross_country_high_specificity"]
    return [_bit("exact_name"), F.bit_count("provenance"), *map(_bit, order)]


def rank(pairs: DataFrame, most: int | None = None) -> DataFrame:
    """pairs with ``rank`` within each record and source: evidence falling, then id. With most, only the first
    ranks are kept, and each task drops the others before they are shuffled."""
    window = Window.partitionBy("s1_id", "source").orderBy(*[t.desc() for t in evidence_tier()], "cand_id")
    ranked = pairs.withColumn("rank", F.row_number().over(window))
    return ranked if most is None else ranked.where(F.col("rank") <= most)


def counts(pairs: DataFrame, cap: int) -> DataFrame:
    """s1_id, source, generated, retained, truncated."""
    return capped_sizes(pairs.groupBy("s1_id", "source").agg(F.count(F.lit(1)).alias("generated")), cap)


def capped_sizes(sizes: DataFrame, cap: int) -> DataFrame:
    """counts from s1_id, source and generated."""
    sizes = sizes.select("s1_id", "source", "generated")
    return sizes.withColumn("retained", F.least("generated", F.lit(cap).cast("long"))).withColumn("truncated", F.col("generated") - F.col("retained"))


def export(s1_ids: DataFrame, pairs: DataFrame, cap: int) -> DataFrame:
    """s1_ids (s1_id and others) with ``candidates``: the ids kept, those of S2 before those of S3, each in order.
    Pairs that have ranks already are not ranked again."""
    told = pairs.where(F.col("cand_id").rlike("^S[23]-"))
    kept = told.where(F.col("rank") <= cap) if "rank" in pairs.columns else rank(told, cap)
    lists = kept.groupBy("s1_id").agg(F.concat_ws(",", F.array_sort(F.collect_list("cand_id"))).alias("candidates"))
    return s1_ids.join(lists, "s1_id", "left").withColumn("candidates", F.coalesce("candidates", F.lit("")))


def distribution(values: DataFrame, column: str) -> DataFrame:
    """min, median, mean, p95, p99, max of a column of counts; quantiles are the value at place int(n * p) in order.

    The counts are counted first, so that what is ranked has a row for each different count.
    """
    counted = values.groupBy(F.col(column).cast("long").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    below = counted.withColumn("below", F.sum("n").over(Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(1))))
    at = lambda place: F.coalesce(F.min(F.when(F.col("below") > place, F.col("value"))), F.lit(0))
    total = F.col("total")
    zero = F.lit(0).cast("long")
    return below.agg(
        F.coalesce(F.min("value"), zero).alias("min"), at(F.floor(total / 2)).alias("median"),
        F.coalesce(F.sum(F.col("value") * F.col("n")) / F.sum("n"), F.lit(0.0)).alias("mean"),
        at(F.floor(total * F.lit(0.95))).alias("p95"), at(F.floor(total * F.lit(0.99))).alias("p99"), F.coalesce(F.max("value"), zero).alias("max"),
    )


def ranked(found: DataFrame) -> DataFrame:
    """s1_id, source, cand_id, provenance and rank of the pairs that Blocking.found kept."""
    return found.select("s1_id", "source", F.inline("kept"))


def found_of(pairs: DataFrame, most: int) -> DataFrame:
    """s1_id, source, generated and kept of pairs, as Blocking.found has them, with ranks up to most."""
    kept = F.collect_list(F.when(F.col("rank") <= most, F.struct("cand_id", "provenance", "rank")))
    return rank(pairs).groupBy("s1_id", "source").agg(F.count(F.lit(1)).alias("generated"), kept.alias("kept"))


def provenance_breakdown(pairs: DataFrame) -> DataFrame:
    """kind, name, n: pairs in all, by source, and by pass."""
    return breakdown_of_masks(pairs.groupBy("provenance", "source").agg(F.count(F.lit(1)).alias("n")))


def breakdown_of_masks(masks: DataFrame) -> DataFrame:
    """provenance_breakdown from n pairs of each provenance and source."""
    kinds = [F.struct(F.lit("total").alias("kind"), F.lit("all").alias("name"), F.lit(True).alias("holds")), F.struct(F.lit("source").alias("kind"), F.col("source").alias("name"), F.lit(True).alias("holds"))]
    kinds += [F.struct(F.lit("pass").alias("kind"), F.lit(p).alias("name"), (F.col("provenance").bitwiseAND(bit) > 0).alias("holds")) for p, bit in PROVENANCE.items()]
    return masks.select("n", F.inline(F.array(*kinds))).groupBy("kind", "name").agg(F.sum(F.when(F.col("holds"), F.col("n")).otherwise(0)).alias("n"))
