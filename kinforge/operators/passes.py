"""Blocking passes: pairs (s1_id, source, cand_id, bit) by equality of keys, as joins of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PROVENANCE, BlockingConfig
from ..sources.shared import stage
from .postings import FAMILIES, PASS_OF

EVENT = "s1_id string, source string, block_family string, key string, generated_count long, retained_count long, truncated_count long, is_filtered boolean, refinement_attempted boolean, refined boolean"
BLOCK = ["source", "country", "family", "key"]


def _tag(pairs: DataFrame, name: str) -> DataFrame:
    return pairs.select("s1_id", "source", "cand_id", F.lit(PROVENANCE[name]).alias("bit"))


def exact_name(s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """Equal names within a known country."""
    left = s1.where("country <> '' and name <> ''").select(F.col("entity_id").alias("s1_id"), "country", "name")
    right = candidates.where("name <> ''").select("source", F.col("entity_id").alias("cand_id"), "country", "name")
    return _tag(left.join(right, ["country", "name"]), "exact_name")


class Blocks:
    """The same-country passes of one or more families: small blocks whole, larger ones refined by a second key.

    A block above ``max_block_size`` is replaced by its intersection with the first other key of the record for
    which that is neither empty nor too large; without such a key it is kept whole. For n-grams the other key
    must start at least an n-gram further along the distinct keys.
    """

    def __init__(self, asked: DataFrame, posted: DataFrame, frequent: DataFrame, config: BlockingConfig, families: tuple[str, ...] = FAMILIES):
        self.config = config
        self.posted = posted.where(F.col("family").isin(*families))
        asked = asked.where(F.col("family").isin(*families) & (F.col("country") != ""))
        met = stage(asked.join(frequent.select(*BLOCK, "n", "filtered"), ["country", "family", "key"]), "met-keys")
        self.dropped = met.where("filtered")
        usable = met.where("not filtered")
        self.small = usable.where(F.col("n") <= config.max_block_size)
        self.big = usable.where(F.col("n") > config.max_block_size)
        other = usable.select("s1_id", "source", "family", F.col("pos").alias("pos2"), F.col("key").alias("key2"))
        apart = F.when(F.col("family") == "ngram", F.abs(F.col("pos") - F.col("pos2")) >= config.ngram_size).otherwise(F.col("pos") != F.col("pos2"))
        partners = self.big.join(other, ["s1_id", "source", "family"]).where(apart)
        wanted = stage(partners.select(*BLOCK, "key2").distinct(), "wanted-partners")
        # the blocks that meet, each as one list of at most the family's document frequency, are intersected once for
        # each pair of keys
        met_keys = wanted.select(*BLOCK).unionByName(wanted.select("source", "country", "family", F.col("key2").alias("key"))).distinct()
        lists = self.posted.join(met_keys, BLOCK, "left_semi").groupBy(*BLOCK).agg(F.collect_list("cand_id").alias("ids"))
        second = lists.withColumnsRenamed({"key": "key2", "ids": "ids2"})
        both = wanted.join(lists, BLOCK).join(second, ["source", "country", "family", "key2"])
        common = both.select(*BLOCK, "key2", F.array_intersect("ids", "ids2").alias("cand_ids")).withColumn("n2", F.size("cand_ids").cast("long"))
        common = stage(common.where((F.col("n2") > 0) & (F.col("n2") <= config.max_block_size)), "common-postings")
        ranked = partners.join(common, [*BLOCK, "key2"]).groupBy("s1_id", "pos", "n", *BLOCK).agg(F.min_by(F.struct("key2", "n2", "cand_ids"), "pos2").alias("best"))
        self.refined = stage(ranked.select("s1_id", "pos", "n", *BLOCK, "best.*"), "refined-keys")
        self.whole = self.big.join(self.refined.select("s1_id", "source", "family", "pos"), ["s1_id", "source", "family", "pos"], "left_anti")

    def pairs(self) -> DataFrame:
        """Pairs with the bit of each family."""
        whole = self.small.unionByName(self.whole).select("s1_id", *BLOCK).join(self.posted, BLOCK)
        part = self.refined.select("s1_id", "source", "family", F.explode("cand_ids").alias("cand_id"))
        bit = F.lit(None).cast("int")
        for family, name in PASS_OF.items():
            bit = F.when(F.col("family") == family, PROVENANCE[name]).otherwise(bit)
        both = whole.select("s1_id", "source", "cand_id", "family").unionByName(part.select("s1_id", "source", "cand_id", "family"))
        return both.select("s1_id", "source", "cand_id", bit.alias("bit"))

    def events(self) -> DataFrame:
        """What happened to large and filtered blocks; filtered ones are told for name tokens only."""

        def told(rows: DataFrame, key, generated, retained, filtered: bool, refined: bool) -> DataFrame:
            name = F.lit("")
            for family, title in PASS_OF.items():
                name = F.when(F.col("family") == family, title).otherwise(name)
            truncated = F.lit(0) if filtered else generated - retained
            values = [F.col("s1_id"), F.col("source"), name, key, generated, retained, truncated, F.lit(filtered), F.lit(not filtered), F.lit(refined)]
            return rows.select(*[v.cast(t).alias(c) for v, (c, t) in zip(values, (x.split() for x in EVENT.split(", ")), strict=True)])

        out = told(self.dropped.where("family = 'name'"), F.col("key"), F.lit(-1), F.lit(0), True, False)
        out = out.unionByName(told(self.refined, F.concat_ws("+", "key", "key2"), F.col("n"), F.col("n2"), False, True))
        return out.unionByName(told(self.whole, F.col("key"), F.col("n"), F.col("n"), False, False))


def missing_country(s1: DataFrame, asked: DataFrame, candidates: DataFrame, posted: DataFrame, frequent: DataFrame) -> DataFrame:
    """Records of known country against candidates without one: equal name, or a key that isn't filtered."""
    names = s1.where("country <> '' and name <> ''").select(F.col("entity_id").alias("s1_id"), "name")
    by_name = names.join(candidates.where("country = ''").select("source", F.col("entity_id").alias("cand_id"), "name"), "name")
    usable = frequent.where("country = '' and not filtered and family in ('name', 'num_loc')").select("source", "family", "key")
    found = asked.where("country <> ''").select("s1_id", "family", "key").join(usable, ["family", "key"])
    by_key = found.join(posted.where("country = ''").drop("country"), ["source", "family", "key"])
    return _tag(by_name.select("s1_id", "source", "cand_id").unionByName(by_key.select("s1_id", "source", "cand_id")).distinct(), "missing_country_fallback")


def global_fallback(s1: DataFrame, asked: DataFrame, candidates: DataFrame, posted: DataFrame) -> DataFrame:
    """Records without a country against all candidates: equal name, name token, or number and location."""
    names = s1.where("country = '' and name <> ''").select(F.col("entity_id").alias("s1_id"), "name")
    by_name = names.join(candidates.select("source", F.col("entity_id").alias("cand_id"), "name"), "name")
    by_key = asked.where("country = '' and family in ('name', 'num_loc')").select("s1_id", "family", "key").join(posted.select("source", "family", "key", "cand_id"), ["family", "key"])
    return _tag(by_name.select("s1_id", "source", "cand_id").unionByName(by_key.select("s1_id", "source", "cand_id")).distinct(), "missing_country_fallback")


def merge(*found: DataFrame) -> DataFrame:
    """One row for each pair, with the bits of all its passes: s1_id, source, cand_id, provenance."""
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("s1_id", "source", "cand_id").agg(F.bit_or("bit").alias("provenance"))
