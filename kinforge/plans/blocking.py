"""The blocking plan: from records to merged candidate pairs, and what is told about it."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lists, matching, passes, postings
from ..schema import BlockingConfig
from ..sources import shared
from ..sources.shared import stage

TABLES = ("candidates", "posted", "counts")


def _spread(records: DataFrame) -> DataFrame:
    """A small input in few pieces goes to all cores, which then cut its keys."""
    cores = records.sparkSession.sparkContext.defaultParallelism
    return records.repartition(cores) if records.rdd.getNumPartitions() < cores else records


class CandidateIndex:
    """What blocking knows of the candidates: records, postings and counts of keys, each a staged table.

    It can be asked any number of times, grow by more candidates (only these are cut into keys), and be kept in a
    folder. candidates (source, entity_id, name, address, country) are read often: stage them before.
    """

    def __init__(self, candidates: DataFrame, posted: DataFrame | None, counts: DataFrame | None, config: BlockingConfig):
        """posted and counts: by default they are made when they are first asked for."""
        self.candidates, self.config = candidates, config
        self._posted, self._counts = posted, counts

    @classmethod
    def build(cls, candidates: DataFrame, config: BlockingConfig) -> CandidateIndex:
        return cls(candidates, None, None, config)

    @property
    def posted(self) -> DataFrame:
        if self._posted is None:
            self._posted = stage(postings.postings(self.candidates, self.config), "postings")
        return self._posted

    @property
    def counts(self) -> DataFrame:
        if self._counts is None:
            self._counts = stage(postings.key_counts(self.posted), "key-counts")
        return self._counts

    def add(self, candidates: DataFrame) -> CandidateIndex:
        """An index of these and more candidates."""
        more = CandidateIndex.build(stage(_spread(candidates), "candidates"), self.config)
        both = self.counts.unionByName(more.counts).groupBy(*passes.BLOCK).agg(F.sum("n").alias("n"))
        return CandidateIndex(self.candidates.unionByName(more.candidates), self.posted.unionByName(more.posted), stage(both, "key-counts"), self.config)

    def save(self, folder: str) -> None:
        for name in TABLES:
            getattr(self, name).write.mode("overwrite").parquet(f"{folder}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, config: BlockingConfig) -> CandidateIndex:
        return cls(*[spark.read.parquet(f"{folder}/{name}") for name in TABLES], config)

    @cached_property
    def totals(self) -> DataFrame:
        return postings.totals(self.candidates)

    @cached_property
    def frequencies(self) -> DataFrame:
        return stage(postings.filtered(self.counts, self.totals, self.config), "frequencies")

    @cached_property
    def keyed(self) -> DataFrame:
        """What all passes together read."""
        return stage(matching.keyed(self.candidates, self.config), "keyed")

    @cached_property
    def countries(self) -> DataFrame:
        """source, country: the countries that each source's records name."""
        return self.candidates.where("country <> ''").select("source", "country").distinct()

    def size_bytes(self) -> int:
        """Bytes on disk of the tables' files that it has made and reads."""
        spark = self.candidates.sparkSession
        tables = (self.candidates, self._posted, self._counts, self.__dict__.get("keyed"))
        paths = {f.rsplit("/", 1)[0] for table in tables if table is not None for f in table.inputFiles()}
        return sum(shared.file_system(spark, p)[0].getContentSummary(shared.file_system(spark, p)[1]).getLength() for p in paths)


class Blocking:
    """All frames of one blocking run. records: source, entity_id, name, address, country; S1 asks.

    What several passes read (records, keys, frequencies, merged pairs) is written once, when it is first asked
    for, so that texts are normalized and cut into keys once.
    """

    def __init__(self, records: DataFrame, config: BlockingConfig, index: CandidateIndex | None = None):
        """index: the candidates; by default they are the records of records that are not of S1."""
        records = stage(_spread(records), "records")
        self.records, self.config, self._given = records, config, index
        self.s1 = records.where("source = 'S1'")
        self._blocks: dict[tuple[str, ...], passes.Blocks] = {}

    @cached_property
    def index(self) -> CandidateIndex:
        return self._given or CandidateIndex.build(self.candidates, self.config)

    @property
    def candidates(self) -> DataFrame:
        return self._given.candidates if self._given else self.records.where("source <> 'S1'")

    @property
    def posted(self) -> DataFrame:
        return self.index.posted

    @property
    def totals(self) -> DataFrame:
        return self.index.totals

    @property
    def frequencies(self) -> DataFrame:
        return self.index.frequencies

    @cached_property
    def asked(self) -> DataFrame:
        return stage(postings.query_keys(self.s1, self.config), "asked-keys")

    def blocks(self, *families: str) -> passes.Blocks:
        families = families or postings.FAMILIES
        if families not in self._blocks:
            self._blocks[families] = passes.Blocks(self.asked, self.posted, self.frequencies, self.config, families)
        return self._blocks[families]

    def exact_name(self) -> DataFrame:
        return passes.exact_name(self.s1, self.candidates)

    def missing_country(self) -> DataFrame:
        return passes.missing_country(self.s1, self.asked, self.candidates, self.posted, self.frequencies)

    def global_fallback(self) -> DataFrame:
        return passes.global_fallback(self.s1, self.asked, self.candidates, self.posted)

    def cross_country(self, told: tuple[str, ...] = ("s1_id", "source", "cand_id", "provenance")) -> DataFrame:
        """Pairs of different known countries by equal name, enough shared name tokens, or a number and location that few
        records of other countries have."""
        return self._pairs(matching.ALONE, told).withColumnRenamed("provenance", "bit")

    @cached_property
    def _sizes(self) -> tuple[list[str], int]:
        """The candidates' sources, and into how many shares the records that ask are cut."""
        sources = sorted(r["source"] for r in self.candidates.select("source").distinct().collect() if r["source"] is not None)
        asking = self.s1.count()
        cores = self.records.sparkSession.sparkContext.defaultParallelism
        return sources, max(1, min(cores, asking // 64), asking // matching.SHARE)

    def _cells(self, wanted: DataFrame | None = None, of: frozenset[str] | None = None) -> DataFrame:
        sources, shares = self._sizes
        candidates = self._given.keyed if self._given else matching.keyed(self.candidates, self.config, of)
        return matching.cells(matching.keyed(self.s1, self.config, of), candidates, sources, shares, wanted)

    @property
    def pairs(self) -> DataFrame:
        """s1_id, source, cand_id, provenance of all passes. They are made anew wherever they are read, as this costs less
        than to write them; what is read more than once has a smaller form in found."""
        return self._pairs(matching.passes_of(self.config))

    def listed(self) -> DataFrame:
        """pairs without their source."""
        return self._pairs(matching.passes_of(self.config), ("s1_id", "cand_id", "provenance"))

    def lists(self) -> DataFrame:
        """pairs as lists.LIST, which a store takes: some two bytes for each pair."""
        if not self._sizes[0]:
            return self.records.sparkSession.createDataFrame([], lists.LIST)
        return matching.listed(self._cells(), *self._sizes, self.config)

    def _pairs(self, of: frozenset[str], told: tuple[str, ...] = ("s1_id", "source", "cand_id", "provenance")) -> DataFrame:
        if not self._sizes[0]:
            return self.records.sparkSession.createDataFrame([], matching.PAIR).select(*told)
        return matching.pairs(self._cells(of=of), *self._sizes, self.config, of, told)

    def found(self, most: int = 0, wanted: DataFrame | None = None, events: bool = False) -> DataFrame:
        """For each record and source with pairs: their number, also by mask, and with ranks the first ``most`` and those of
        wanted (s1_id, cand_id), as one staged row. With events also how many blocks overflowed (matching.EVENTS), and rows
        with these alone."""
        if not self._sizes[0]:
            return self.records.sparkSession.createDataFrame([], matching.found_schema(events))
        return stage(matching.found(self._cells(wanted), *self._sizes, self.config, most, events), "found")


def candidates_for(record: tuple[str, str, str, str], candidates: DataFrame | CandidateIndex, config: BlockingConfig) -> dict[str, int]:
    """Candidate ids and masks of one normalized record: id, name, address, country. An index is asked as it is."""
    index = candidates if isinstance(candidates, CandidateIndex) else CandidateIndex.build(stage(_spread(candidates), "candidates"), config)
    row = index.candidates.sparkSession.createDataFrame([("S1", *record)], "source string, entity_id string, name string, address string, country string")
    return {r["cand_id"]: r["provenance"] for r in Blocking(row, config, index).pairs.collect()}
