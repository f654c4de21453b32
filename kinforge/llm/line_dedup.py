"""Line dedup by levelled sorted runs of line hashes.

Each document's distinct line keys (128 bits of hash each) come in batches of documents. A batch is counted and written
as a sorted run of level 0. It is merge-anti-joined with the settled runs, those of keys already found in enough
documents; what is left is merge-joined with the older counted runs, and keys that reach the threshold with it become
a settled run. When ``FANOUT`` runs stand on one level they are compacted: merged by key, without settled keys, into
one run of the next level. Runs are Parquet tables bucketed and sorted by key, one file a bucket, and are read in that
order, so merging them needs neither shuffle nor sort. With a folder they outlive the process: a corpus that grows
adds its new documents as a batch to the runs of the old ones.

Then the lines of settled keys are dropped. Documents that lose none are told by a Bloom filter of those that do and
pass straight through; only the others shuffle, to meet the places of their settled lines.

A key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lowered. Keys of at least ``least_chars`` code
points found in at least ``least_docs`` documents lose all their lines.

Defined results: a null text is one empty line, which is kept; keys shorter than least_chars are never
dropped; a document whose lines are all dropped has an empty text; whole texts are cut, however long; rows that repeat
both id and text count as one document and lose the same lines; an empty table gives an empty result; other columns
are carried.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrow_text import map_texts, whole_row
from .bloom import BloomFilter
from .exact_dedup import ascii_lower
from .staging import file_system, new_path, stage

BATCHES, FANOUT = 4, 2
LEAST_CHARS, LEAST_DOCS = 1, 10


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


@contextlib.contextmanager
def _in_file_order(spark: SparkSession) -> Iterator[None]:
    """Within it, bucketed tables of one file a bucket are read as sorted as they were written."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Runs:
    """Sorted runs (h1, h2, n) of counted keys by level, and of settled keys.

    folder: where they are kept; if it holds runs they are taken up. Without it they go with the application. What a
    batch changes holds once its manifest is written, so a batch that failed can be added again. Leaving the context
    takes the tables out of the session's catalogue; files stay.
    """

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fanout: int = FANOUT, folder: str | None = None):
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.folder = (folder or new_path(spark, "line-runs")).rstrip("/")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.version = 0
        self.levels: list[list[str]] = []  # names of runs
        self.settled_runs: list[str] = []
        self.names: list[str] = []
        files, at = file_system(spark, f"{self.folder}/manifest-*.json")
        found = sorted(str(f.getPath()) for f in files.globStatus(at) or [])
        if found:
            state = json.loads(spark.read.text(found[-1], wholetext=True).first()[0])
            self.version, self.buckets, self.levels, self.settled_runs = state["version"], state["buckets"], state["levels"], state["settled"]
            for name in [*self.settled_runs, *(n for level in self.levels for n in level)]:
                spark.sql(f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, n BIGINT) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'")
                self.names.append(name)

    def __enter__(self) -> Runs:
        return self

    def __exit__(self, *error) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []

    def _write(self, rows: DataFrame) -> str:
        name = f"kinforge_run_{uuid.uuid4().hex}"
        self.names.append(name)
        rows.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        """All keys of some runs with the sums of their counts, two runs at a time."""
        first, *rest = names
        if not rest:
            return self.spark.table(first)
        if len(rest) > 1:
            rest = [self._write(self._merged(rest))]
        other = self.spark.table(rest[0]).withColumnRenamed("n", "more")
        return self.spark.table(first).join(other, ["h1", "h2"], "full_outer").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))

    def _all_settled(self) -> DataFrame:
        """The settled runs, which have no key in common."""
        rows = self.spark.table(self.settled_runs[0])
        for name in self.settled_runs[1:]:
            rows = rows.unionByName(self.spark.table(name))
        return rows

    def _unsettled(self, rows: DataFrame) -> DataFrame:
        for name in self.settled_runs:
            rows = rows.join(self.spark.table(name), ["h1", "h2"], "left_anti")
        return rows

    def add(self, keys: DataFrame) -> None:
        """keys: h1, h2, a row for each document that has the key. Their batch becomes a run."""
        with _in_file_order(self.spark):
            run = self._write(keys.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")))
            total = self._unsettled(self.spark.table(run))
            for name in [n for level in self.levels for n in level]:
                older = self.spark.table(name).withColumnRenamed("n", "more")
                total = total.join(older, ["h1", "h2"], "left").select("h1", "h2", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
            self.settled_runs = [*self.settled_runs, self._write(total.where(F.col("n") >= self.least_docs))]
            self.levels = [[run, *self.levels[0]] if self.levels else [run], *self.levels[1:]]
            level = 0
            while level < len(self.levels):
                if len(self.levels[level]) >= self.fanout:
                    up = self._write(self._unsettled(self._merged(self.levels[level])))
                    self.levels = [*self.levels[:level], [], *(self.levels[level + 1 :] or [[]])]
                    self.levels[level + 1] = [up, *self.levels[level + 1]]
                level += 1
            if len(self.settled_runs) > self.fanout:
                self.settled_runs = [self._write(self._merged(self.settled_runs))]
        self._save()

    def _save(self) -> None:
        """Write the manifest; then what it no longer names can go."""
        self.version += 1
        files, at = file_system(self.spark, f"{self.folder}/manifest-{self.version:09}.json")
        out = files.create(at, False)
        out.write(json.dumps({"version": self.version, "buckets": self.buckets, "levels": self.levels, "settled": self.settled_runs}).encode())
        out.close()
        kept = {*self.settled_runs, *(n for level in self.levels for n in level)}
        for name in set(self.names) - kept:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            files.delete(file_system(self.spark, f"{self.folder}/{name}")[1], True)
        self.names = [n for n in self.names if n in kept]
        if self.version > 1:
            files.delete(file_system(self.spark, f"{self.folder}/manifest-{self.version - 1:09}.json")[1], False)

    def settled(self) -> DataFrame:
        """The keys (h1, h2) found in enough documents so far; staged, so it outlives the runs."""
        if not self.settled_runs:
            return self.spark.range(0).select(F.col("id").alias("h1"), F.col("id").alias("h2"))
        return stage(self._all_settled().select("h1", "h2"), "settled-keys")


def line_hashes(docs: DataFrame, id_col: str, text_col: str, least_chars: int, batches: int) -> DataFrame:
    """Staged: a row for each document: batch, row_no, id, same (a hash of the text), and hashes, one for each line
    (null where its key is too short). Rows that repeat id and text are one document: hashes is null in the others."""
    text = F.col(f"`{text_col}`")
    keys = F.transform(_lines(text), line_key)
    hashes = F.transform(keys, lambda k: F.when(F.length(k) >= least_chars, _hash(k)))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("same"), hashes.alias("hashes"))
    batch = F.pmod(F.xxhash64("id", "same"), F.lit(batches)).cast("int")
    rows = stage(rows.select(batch.alias("batch"), F.monotonically_increasing_id().alias("row_no"), "id", "same", "hashes"), "line-keys", ["batch"])
    again = rows.groupBy(F.col("id").alias("id_"), F.col("same").alias("same_")).agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    again = stage(again, "repeated-rows")
    if again.isEmpty():
        return rows
    marked = rows.join(again, rows["id"].eqNullSafe(F.col("id_")) & (rows["same"] == F.col("same_")), "left")
    return marked.withColumn("hashes", F.when(F.col("first").isNull() | (F.col("first") == F.col("row_no")), F.col("hashes"))).drop("id_", "same_", "first", "n_rows")


def add_batches(runs: Runs, hashes: DataFrame, batches: int) -> None:
    """Add the documents of line_hashes to the runs, batch by batch."""
    for b in range(batches):
        keys = F.explode(F.array_distinct(F.filter("hashes", lambda h: h.isNotNull()))).alias("k")
        runs.add(hashes.where(F.col("batch") == b).select(keys).select("k.h1", "k.h2"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, carry: list[str] | None = None, folder: str | None = None) -> DataFrame:
    """``row`` (a struct of the carried columns, all by default), n_lines, n_dropped and kept_text. folder: runs of
    earlier documents, which count too; docs are added to them."""
    text, same = F.col(f"`{text_col}`"), F.xxhash64(F.col(f"`{text_col}`"))
    hashes = line_hashes(docs, id_col, text_col, least_chars, batches)
    with Runs(docs.sparkSession, least_docs, folder=folder) as runs:
        add_batches(runs, hashes, batches)
        settled = runs.settled()
    lines = hashes.select("id", "same", F.posexplode("hashes").alias("place", "k")).select("id", "same", "place", "k.h1", "k.h2")
    places = lines.join(settled, ["h1", "h2"], "left_semi").groupBy("id", "same").agg(F.collect_set("place").alias("places"))
    places = stage(places.select(F.xxhash64("id", "same").alias("key"), "id", "same", "places"), "line-places")

    row = whole_row(docs.select(*[F.col(f"`{c}`") for c in carry])) if carry else whole_row(docs)
    rows = docs.select(row.alias("row"), text.alias("text"), F.col(f"`{id_col}`").alias("id"), same.alias("same"))
    marked = BloomFilter(places.select("key")).mark(rows, F.xxhash64("id", "same"))
    whole = marked.where(~F.col("maybe")).select("row", F.size(_lines(F.col("text"))).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.coalesce("text", F.lit("")).alias("kept_text"))
    held = marked.where("maybe")
    joined = held.join(places.withColumnsRenamed({"id": "id_", "same": "same_"}), held["id"].eqNullSafe(F.col("id_")) & (held["same"] == F.col("same_")), "left").select("row", "text", "places")

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("row"), *_rest(batch.column("text").to_pylist(), batch.column("places").to_pylist())], names=["row", "n_lines", "n_dropped", "kept_text"])

    schema = StructType([joined.schema["row"], StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_text", StringType())])
    return whole.unionByName(map_texts(joined, kernel, schema, "text"))


def _rest(texts: list[str | None], places: list[list[int] | None]) -> Iterator[pa.Array]:
    lines = [(t or "").split("\n") for t in texts]
    gone = [set(p or ()) for p in places]
    yield pa.array([len(x) for x in lines], pa.int64())
    yield pa.array([len(g) for g in gone], pa.int64())
    yield pa.array(["\n".join(x for i, x in enumerate(ls) if i not in g) if g else "\n".join(ls) for ls, g in zip(lines, gone, strict=True)], pa.string())
