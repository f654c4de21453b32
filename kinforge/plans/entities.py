"""A deterministic view of the table documents as entities of three sources, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean
from ..schema import BlockingConfig
from ..sources.shared import stage

#: As the defaults, with blocks so small that refinement is met at every scale.
CONFIG = BlockingConfig(max_block_size=3, max_candidates_per_source=3)
#: True pairs of one name that one task makes, about.
PART = 1 << 20


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, entity_id and the three raw values."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "n_chars")
    flat = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    country = F.when(F.col("doc_id") % 23 == 0, "").when(F.col("doc_id") % 5 == 0, "xx").otherwise(F.col("lang"))
    return docs.select(
        "doc_id",
        F.concat(F.lit("S"), (1 + F.col("doc_id") % 3).cast("string"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("entity_id"),
        F.substring(flat, 1, 40).alias("business_name"),
        F.concat(F.col("n_chars").cast("string"), F.lit(" "), F.substring(flat, 41, 60)).alias("business_address"),
        country.alias("country"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw(spark, sf_dir))


def records(rows: DataFrame) -> DataFrame:
    """Cleaned rows as what blocking reads: source, entity_id, name, address, country."""
    return rows.select(F.substring("entity_id", 1, 2).alias("source"), "entity_id", F.col("business_name_normalized").alias("name"), F.col("business_address_normalized").alias("address"), F.col("country_normalized").alias("country"))


def ground_truth(rows: DataFrame) -> DataFrame:
    """s1_id and matched: the records of the other sources with the same name. A record without any has an empty list."""
    named = rows.select("source", "entity_id", "name")
    s1 = named.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "name")
    others = named.where("source <> 'S1' and name <> ''").select(F.col("entity_id").alias("cand_id"), "name")
    asked = s1.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    lists = others.groupBy("name").agg(F.array_sort(F.collect_list("cand_id")).alias("matched")).join(asked, "name")
    lists = stage(lists.select("name", "matched", F.ceil(F.col("n") * F.size("matched") / PART).cast("int").alias("parts")), "names")
    # a frequent name is dealt out: each part of its records gets the list
    many = lists.where("parts > 1").select("name", "parts")
    part = F.pmod(F.xxhash64("s1_id"), F.coalesce("parts", F.lit(1))).cast("int")
    s1 = s1.join(many, "name", "left").select("s1_id", "name", part.alias("part"))
    matched = lists.select("name", "matched", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return s1.join(matched, ["name", "part"], "left").select("s1_id", "matched").withColumn("matched", F.coalesce("matched", F.expr("cast(array() as array<string>)")))
