"""Blocking keys of both sides, their document frequencies, and which keys are too frequent.

A record is (source, entity_id, name, address, country), all normalized. Postings are tall: source, family,
country, key, cand_id; a family's thresholds come from the whole source's number of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..schema import BlockingConfig

FAMILIES = ("name", "addr", "num_loc", "ngram")
#: The pass of each family.
PASS_OF = {"name": "rare_name_token", "addr": "address_token", "num_loc": "address_number_location", "ngram": "compact_char_ngram"}


def keys_of(family: str, config: BlockingConfig) -> Column:
    name, address = F.col("name"), F.col("address")
    return {
        "name": lambda: keys.name_tokens(name, config.legal_stoplist, config.min_token_length),
        "addr": lambda: keys.address_tokens(address, config.address_stoplist, config.min_addr_token_length),
        "num_loc": lambda: keys.number_location_keys(address, config.min_addr_token_length),
        "ngram": lambda: keys.compact_ngrams(name, config.ngram_size, config.min_ngram_length),
    }[family]()


def all_keys(records: DataFrame, config: BlockingConfig) -> DataFrame:
    """records with an array of (family, pos, key): the distinct keys of each family in order."""

    def named(family: str) -> Column:
        return F.transform(F.array_distinct(keys_of(family, config)), lambda k, i: F.struct(F.lit(family).alias("family"), i.alias("pos"), k.alias("key")))

    arrays = map(named, FAMILIES)
    return records.withColumn("keys", F.concat(*arrays))


def postings(candidates: DataFrame, config: BlockingConfig) -> DataFrame:
    """source, country, family, key, cand_id. Records without a country have no n-grams."""
    rows = all_keys(candidates, config).select("source", "country", F.col("entity_id").alias("cand_id"), F.inline("keys"))
    return rows.where("family <> 'ngram' or country <> ''").select("source", "country", "family", "key", "cand_id")


def totals(candidates: DataFrame) -> DataFrame:
    """For each source its records, countries, and whether some record has no country."""
    return candidates.groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count_distinct(F.when(F.col("country") != "", F.col("country"))).alias("n_countries"), F.bool_or(F.col("country") == "").alias("has_missing_country"))


def max_df(config: BlockingConfig) -> Column:
    """The threshold of a row with family and total."""
    out = F.lit(None).cast("long")
    for f, absolute, relative in (("name", config.max_name_df_absolute, config.max_name_df_relative), ("addr", config.max_addr_df_absolute, config.max_addr_df_relative), ("num_loc", config.max_addr_df_absolute, config.max_addr_df_relative), ("ngram", config.max_ngram_df_absolute, config.max_ngram_df_relative)):
        out = F.when(F.col("family") == f, F.least(F.lit(absolute), F.greatest(F.lit(5), F.floor(F.col("total") * F.lit(relative))))).otherwise(out)
    return out


def key_counts(posted: DataFrame) -> DataFrame:
    """source, country, family, key, n: in how many records each key is."""
    return posted.groupBy("source", "country", "family", "key").agg(F.count(F.lit(1)).alias("n"))


def filtered(counts: DataFrame, sizes: DataFrame, config: BlockingConfig) -> DataFrame:
    """counts with filtered: whether a key is in too many records.

    sizes has a row for each source, so it is sent to all tasks.
    """
    return counts.join(F.broadcast(sizes.select("source", "total")), "source").withColumn("filtered", F.col("n") > max_df(config)).drop("total")


def query_keys(s1: DataFrame, config: BlockingConfig) -> DataFrame:
    """s1_id, country, family, pos, key."""
    return all_keys(s1, config).select(F.col("entity_id").alias("s1_id"), "country", F.inline("keys"))
