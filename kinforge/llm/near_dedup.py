"""MinHash near-dedup with sequential Bayesian verification.

A text's words ``[^\\x20\\x09-\\x0D]+``, A-Z lowered, give the set of its distinct w-word shingles (64-bit
hashes of their bytes). Texts of equal sets form a class at once, by count and 128 bits of set hash; only one
of each class goes on. Its minima are banded so that two sets at the threshold share no band with a chance of
``BAND_MISS`` at most (``layout``: 25 bands of 6 rows at 0.85, 29 of 5 at 0.80), and less above it.

Candidates are pairs that share a band's bucket. Buckets of up to ``PAIRED`` members give all their pairs; a
larger bucket first gives the pairs with one member of its own. Candidates are compared by batches of ``BATCH``
signature values; after each batch those are dropped whose posterior chance of reaching the threshold (uniform
prior) is under ``MISS``. The survivors are verified exactly on their full sets, and links are joined to
components. In larger buckets that still hold several components, the members outside the largest one are
compared with all others, block against block: first by signatures alone, which tells the rows of a block that have a
survivor in another component; only these rows take their sets to the block, where survivors are verified exactly.
Only links that join components leave it. Thus every candidate pair is either verified or already connected by
verified links, no task holds more than two blocks, and no group is written out as all its pairs.

Defined results: texts without words have no shingles and link with nothing; with fewer than w words the whole
sequence is the one shingle; whole texts are read, however long; ids are integers (others raise), and null ids take no
part in links; rows that repeat are copies of each other; of equally good members the smallest id names a component;
an empty table gives an empty result; other columns, whatever their names, are carried by ``dedupe``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .arrow_text import map_texts, mix, small_batches, span_hashes, text_buffers, whole_row, word_bounds
from .components import components
from .staging import stage

SHINGLE, PERCENT = 5, 80
BATCH, MISS, BAND_MISS = 16, 1e-5, 1e-5
#: Members of a bucket that gives all its pairs; rows and bytes of sets in a block of a larger one.
PAIRED, BLOCK_ROWS, BLOCK_BYTES = 16, 256, 8 << 20
#: Minima of a signature, at most.
MOST_MINIMA = 160
_random = np.random.default_rng(20240229)
_XOR = _random.integers(0, 1 << 63, MOST_MINIMA, dtype=np.uint64)
_TIMES = _random.integers(0, 1 << 63, MOST_MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def layout(percent: int) -> tuple[int, int]:
    """Rows of a band and bands: the longest bands with which a pair at the threshold is missed with a chance of at
    most BAND_MISS, within MOST_MINIMA minima (single rows where none are enough)."""
    for rows in range(16, 0, -1):
        shared = (percent / 100) ** rows
        bands = 1 if shared >= 1 else math.ceil(math.log(BAND_MISS) / math.log1p(-shared))
        if rows * bands <= MOST_MINIMA:
            return rows, bands
    return 1, MOST_MINIMA


def shingles(texts: pa.Array, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, one text after another; and counts per text."""
    raw, offsets = text_buffers(texts)
    raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
    n = len(offsets) - 1
    starts, ends, doc = word_bounds(raw, offsets)
    words = span_hashes(raw, starts, ends)
    n_words = np.bincount(doc, minlength=n)

    def joined(first: np.ndarray, k: int) -> np.ndarray:
        out = np.full(len(first), k, dtype=np.uint64)
        for i in range(k):
            out = mix(out ^ words[first + i])
        return out

    first = np.flatnonzero(doc[: max(0, len(doc) - w + 1)] == doc[w - 1 :])
    values, of = [joined(first, w)], [doc[first]]
    begins = np.cumsum(n_words) - n_words
    for k in range(1, w):
        short = np.flatnonzero(n_words == k)
        values.append(joined(begins[short], k))
        of.append(short)
    value, of = np.concatenate(values), np.concatenate(of)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    if len(value):
        new = np.append(True, (of[1:] != of[:-1]) | (value[1:] != value[:-1]))
        value, of = value[new], of[new]
    return value, np.bincount(of, minlength=n)


def minima(values: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Signatures (texts x n) of texts with shingles; zeros for the others."""
    out = np.zeros((len(counts), n), dtype=np.uint32)
    some = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[some]
    if len(some):
        for k in range(n):
            out[some, k] = np.minimum.reduceat((values ^ _XOR[k]) * _TIMES[k], starts) >> np.uint64(32)
    return out


def _binaries(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary for each run of counts of flat's elements."""
    ends = np.concatenate([[0], np.cumsum(counts) * flat.itemsize])
    if ends[-1] < 1 << 31:
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])
    return pa.array([flat[a:b].tobytes() for a, b in zip((ends[:-1] // flat.itemsize).tolist(), (ends[1:] // flat.itemsize).tolist(), strict=True)], pa.binary())


def signatures(docs: DataFrame, id_col: str, text_col: str, w: int, percent: int) -> DataFrame:
    """id, n, s1 and s2 (hashes of the set), bands (a key each), and signature (a byte of each minimum)."""
    in_band, n_bands = layout(percent)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts = shingles(batch.column("text"), w)
        some = np.flatnonzero(counts)
        set_hash = np.zeros((2, len(counts)), dtype=np.uint64)
        if len(some):
            starts = (np.cumsum(counts) - counts)[some]
            for i, salt in enumerate((0x1F, 0x2E3)):
                set_hash[i, some] = np.add.reduceat(mix(values + np.uint64(salt)), starts)
        sig = minima(values, counts, in_band * n_bands)
        keys = np.zeros((len(counts), n_bands), dtype=np.uint64)
        for i in range(in_band):
            keys = mix(keys ^ (sig[:, i::in_band].astype(np.uint64) + np.uint64(i << 40)))
        bands = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * n_bands), pa.array(keys.view(np.int64).ravel()))
        low = _binaries((sig & 0xFF).astype(np.uint8).ravel(), np.full(len(counts), in_band * n_bands))
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), *map(pa.array, set_hash.view(np.int64)), bands, low], names=["id", "n", "s1", "s2", "bands", "signature"])

    schema = StructType([StructField(c, LongType()) for c in ("id", "n", "s1", "s2")] + [StructField("bands", ArrayType(LongType())), StructField("signature", BinaryType())])
    return map_texts(rows, kernel, schema, "text")


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For 1, 2, ... whole batches, the matches from which on the posterior chance of a similarity of at least percent
    in a hundred, under a uniform prior and chance matches of one byte value, is at least miss."""
    in_band, n_bands = layout(percent)

    def above(x: float, m: int, n: int) -> float:
        """The chance that Beta(m + 1, n - m + 1) exceeds x: at most m of n + 1 fall below."""
        return math.fsum(math.comb(n + 1, k) * x**k * (1 - x) ** (n + 1 - k) for k in range(m + 1))

    at = lambda s: s + (1 - s) / 256
    out = []
    for n in range(BATCH, in_band * n_bands + 1, BATCH):
        out.append(next(m for m in range(n + 1) if above(at(percent / 100), m, n) >= miss * above(at(0.0), m, n)))
    return out


def survivors(left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows survive all batches, and the matches of those that do."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        on = matches >= need
        alive, matches = alive[on], matches[on]
    return alive, matches


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.uint8)


def _prune(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures may reach the threshold."""
    least = least_matches(percent)
    with_both = pairs
    for side in "ab":
        with_both = with_both.join(signed.select(F.col("id").alias(side), F.col("signature").alias(f"sig_{side}")), side)

    def run(batches):
        for batch in batches:
            alive, _ = survivors(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), least)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in "ab"], names=["a", "b"])

    return with_both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    with_both = pairs
    for side in "ab":
        with_both = with_both.join(sets.select(F.col("id").alias(side), F.col("shingles").alias(f"set_{side}")), side)

    def run(batches):
        for batch in batches:
            both = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            keep = [k for k, (x, y) in enumerate(both) if _similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in "ab"], names=["a", "b"])

    return with_both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # a merge of two sorted runs
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


class _Block:
    """The rows of a block task, read from its table (band, id, label, query, asks, bands, signature)."""

    def __init__(self, group: pa.Table, least: list[int]):
        self.least = least
        self.asks, self.query = (np.asarray(group.column(c).combine_chunks().to_numpy(zero_copy_only=False)) for c in ("asks", "query"))
        self.ids, self.labels = group.column("id").to_numpy(), group.column("label").to_numpy().copy()
        self.bands, self.signature = np.stack(group.column("bands").to_numpy()), _matrix(group.column("signature"))
        self.band = group.column("band")[0].as_py()
        self.others = np.flatnonzero(~self.asks)

    def survivors(self, k: int) -> np.ndarray:
        """The rows of other components whose signatures may reach the threshold with row k, the most similar first.
        Of two rows that both ask the one with the smaller id does; pairs that met in an earlier band are left out."""
        to = self.others[(self.labels[self.others] != self.labels[k]) & (~self.query[self.others] | (self.ids[self.others] > self.ids[k]))]
        if self.band and len(to):
            to = to[~(self.bands[to, : self.band] == self.bands[k, : self.band]).any(axis=1)]
        alive, matches = survivors(np.broadcast_to(self.signature[k], (len(to), self.signature.shape[1])), self.signature[to], self.least)
        return to[alive[np.argsort(-matches, kind="stable")]]


def _within_large(members: DataFrame, signed: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the components that large buckets still hold.

    members: band, key, id. signed: id, bands, signature. sets: id, shingles. In each bucket the members outside its
    largest component meet all others, block against block. A task compares pairs of different components that met in
    no earlier band, verifies the survivors exactly, the most similar first, and joins the components that it links,
    so it gives fewer links than it has rows.
    """
    known = signed.join(sets.select("id", F.octet_length("shingles").alias("bytes")), "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = stage(members.join(known, "id"), "large-buckets")
    sizes = named.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("count"), F.sum("bytes").alias("bytes"))
    largest = sizes.groupBy("band", "key").agg(F.max_by(F.struct("label", "count", "bytes"), F.struct("count", "label")).alias("main"), F.sum("count").alias("n"), F.sum("bytes").alias("bytes")).where("n > main.count")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(size / BLOCK_BYTES)).cast("int")
    # staged, so that the join below shuffles both sides and a bucket of many members may be split
    largest = stage(largest.select("band", "key", F.col("main.label").alias("main"), blocks(F.col("n") - F.col("main.count"), F.col("bytes") - F.col("main.bytes")).alias("n_out"), blocks(F.col("n"), F.col("bytes")).alias("n_all")), "large-bucket-sizes")
    rows = named.join(largest, ["band", "key"]).withColumn("query", F.col("label") != F.col("main"))
    own = lambda count: F.pmod(F.xxhash64("id", "band"), F.col(count)).cast("int")
    as_any = F.transform(F.sequence(F.lit(0), F.col("n_out") - 1), lambda o: F.struct(o.alias("o"), own("n_all").alias("i"), F.lit(False).alias("asks")))
    as_query = F.transform(F.sequence(F.lit(0), F.col("n_all") - 1), lambda i: F.struct(own("n_out").alias("o"), i.alias("i"), F.lit(True).alias("asks")))
    none = F.expr("cast(array() as array<struct<o: int, i: int, asks: boolean>>)")
    columns = ["band", "key", "id", "label", "query", "bands", "signature"]
    dealt = rows.select(*columns, F.explode(F.concat(as_any, F.when(F.col("query"), as_query).otherwise(none))).alias("at")).select(*columns, "at.*")
    least = least_matches(percent)

    def prune(group: pa.Table) -> pa.Table:
        """The rows of the block that have a survivor, as they came."""
        block = _Block(group, least)
        wanted = np.zeros(group.num_rows, dtype=bool)
        for k in np.flatnonzero(block.asks).tolist():
            to = block.survivors(k)
            wanted[to] = True
            wanted[k] |= len(to) > 0
        return group.filter(pa.array(wanted))

    def verify(group: pa.Table) -> pa.Table:
        block = _Block(group, least)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        ids, labels = block.ids, block.labels
        found: list[tuple[int, int]] = []
        for k in np.flatnonzero(block.asks).tolist():
            for m in block.survivors(k).tolist():
                if labels[m] != labels[k] and _similar(sets[k], sets[m], percent):
                    found.append((min(ids[k], ids[m]), max(ids[k], ids[m])))
                    labels[labels == labels[m]] = labels[k]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    at = ["band", "key", "o", "i"]
    wanted = stage(dealt.groupBy(*at).applyInArrow(prune, dealt.schema), "block-survivors")
    return wanted.join(sets, "id").groupBy(*at).applyInArrow(verify, "a long, b long").distinct()


def clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", w: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """A row for each row: id, n_shingles, component_id (the smallest id reached by links)."""
    with small_batches(docs.sparkSession):
        signed = stage(signatures(docs, id_col, text_col, w, percent), "signatures")
        classes = signed.where("n > 0 and id is not null").groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"))
        labels = _linked(signed, docs, id_col, text_col, w, percent)
        # staged, so that both sides of the last join are shuffled for it and a class of many copies may be split
        named = stage(classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("s1", "s2", "n", F.coalesce("label", "rep").alias("component_id")), "classes")
    return signed.select("id", "s1", "s2", "n").join(named, ["s1", "s2", "n"], "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def _linked(signed: DataFrame, docs: DataFrame, id_col: str, text_col: str, w: int, percent: int) -> DataFrame:
    """Labels (id, label) of the classes' first members that aren't their component's smallest."""
    reps = signed.where("n > 0 and id is not null").groupBy("s1", "s2", "n").agg(F.min("id").alias("id"))
    banded = signed.join(reps.select("id"), "id", "left_semi").dropDuplicates(["id"]).select("id", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), F.min_by("id", F.xxhash64("id", "band")).alias("hub")).where("size > 1")
    shared = stage(banded.join(buckets.select((F.col("band") + 0).alias("band"), "key", "size", "hub"), ["band", "key"]), "bucket-members")

    small = shared.where(F.col("size") <= PAIRED).groupBy("band", "key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    pairs = small.select(F.explode(F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b")
    hubs = shared.where(F.col("size") > PAIRED).where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
    ids = stage(shared.select("id").distinct(), "bucket-ids")
    held = stage(signed.join(ids, "id", "left_semi").dropDuplicates(["id"]).select("id", "bands", "signature"), "bucket-signatures")
    sets = stage(_sets(docs, ids, id_col, text_col, w), "bucket-sets")

    likely = stage(_prune(pairs.unionByName(hubs).distinct(), held, percent), "likely-pairs")
    links = stage(_verify(likely, sets, percent), "links")
    labels = components(links)
    large = shared.where(F.col("size") > PAIRED).select("band", "key", "id")
    if large.isEmpty():
        return labels
    more = stage(_within_large(large, held, sets, labels, percent), "links")
    if more.isEmpty():
        return labels
    return components(labels.select(F.col("id").alias("a"), F.col("label").alias("b")).unionByName(more))


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, w: int) -> DataFrame:
    """The full sets of some documents: id and shingles (sorted 64-bit hashes)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).join(ids, "id", "left_semi")

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts = shingles(batch.column("text"), w)
        return pa.RecordBatch.from_arrays([batch.column("id"), _binaries(values, counts)], names=["id", "shingles"])

    return map_texts(rows, kernel, "id long, shingles binary", "text").dropDuplicates(["id"])


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", w: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each component the one with the smallest id.
    Rows of null id all stay; of rows that repeat an id one stays."""
    first = clusters(docs, id_col, text_col, w, percent).where("id = component_id").select("id").distinct()
    key = F.col(f"`{id_col}`")
    rows = docs.select(whole_row(docs).alias("row"), key.cast("long").alias("id"))
    kept = rows.where("id is not null").join(first, "id", "left_semi").dropDuplicates(["id"])
    return kept.select("row.*").unionByName(docs.where(key.isNull()))
