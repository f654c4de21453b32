"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates.

A text's features are its words ``[^\\x20\\x09-\\x0D]+`` and pairs of neighbouring words, hashed to ``2**BITS``
places, valued by the square root of their counts and scaled to length 1; one more place is the bias. Training
sees a bounded sample of labelled rows (``MOST_ROWS``, those of least id hash, so the same rows at any
partitioning) whose features are made on the executors and learnt on the driver by per-coordinate
FTRL-proximal updates; of a text with more than ``MOST_PLACES`` of them, those of the largest counts are learnt from.
Scoring is a sparse dot product of all features of the whole text on the executors; the weights that go there
have a fixed size (``2**BITS + 1`` floats, 1 MB).

Defined results: null and empty texts have the bias alone; whole texts are scored, however long; rows of null id are
scored, not held out, and not learnt from; null labels are not learnt from; ids with more than one label count as
their largest, and of rows that repeat an id the text of least hash is learnt from; without any labelled row every
score is 0.5; equal texts get equal scores; an empty table gives an empty result; other columns are carried as they
are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from .arrow_text import map_texts, mix, small_batches, span_hashes, text_buffers, whole_row, word_bounds

BITS = 18
#: Labelled rows that are learnt from, at most.
MOST_ROWS = 6_000
#: Places of one text that are learnt from, at most.
MOST_PLACES = 4096
EPOCHS = 4


def held_out(id_col: Column) -> Column:
    """Rows whose labels may not be learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (text, place) pairs as two arrays, and their values. Without the bias."""
    raw, offsets = text_buffers(texts)
    n = len(offsets) - 1
    starts, ends, doc = word_bounds(raw, offsets)
    words = span_hashes(raw, starts, ends)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    hashes = np.concatenate([words, mix(words[pair] + np.uint64(0x632BE59BD9B4E019) * words[pair + 1])])
    place = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    key, count = np.unique(np.concatenate([doc, doc[pair]]) << BITS | place, return_counts=True)
    of = key >> BITS
    size = np.sqrt(np.bincount(of, weights=count, minlength=n))
    return of, key & ((1 << BITS) - 1), np.sqrt(count) / size[of]


@dataclass
class Ftrl:
    """FTRL-proximal logistic regression (per-coordinate rates, L1 and L2)."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.001
    l2: float = 0.01

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
        bias = 1 << BITS
        z, n = np.zeros(bias + 1), np.zeros(bias + 1)
        for _ in range(epochs):
            for place, value, label in examples:
                i, x = np.append(place, bias), np.append(value, 1.0)
                zi, ni = z[i], n[i]
                w = self._weights(zi, ni)
                gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
                square = gradient * gradient
                z[i] = zi + gradient - (np.sqrt(ni + square) - np.sqrt(ni)) / self.alpha * w
                n[i] = ni + square
        return self._weights(z, n).astype(np.float32)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_rows: int = MOST_ROWS) -> np.ndarray:
    """Weights learnt from at most most_rows labelled rows that are not held out."""
    usable = labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    chosen = usable.orderBy(F.xxhash64("id"), "id", "label").limit(most_rows).groupBy("id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash")).join(F.broadcast(chosen), "id")

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        of, place, value = features(batch.column("text"))
        ends = np.searchsorted(of, np.arange(batch.num_rows + 1))
        parts = [slice(a, b) if b - a <= MOST_PLACES else a + np.sort(np.argsort(-value[a:b], kind="stable")[:MOST_PLACES]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        lists = [pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (place.astype(np.int32), value.astype(np.float32))]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "hash")), *lists], names=["id", "label", "hash", "place", "value"])

    schema = StructType([*(texts.schema[c] for c in ("id", "label", "hash")), StructField("place", BinaryType()), StructField("value", BinaryType())])
    with small_batches(docs.sparkSession):
        once = map_texts(texts, kernel, schema, "text").groupBy("id").agg(F.min_by(F.struct("label", "place", "value"), "hash").alias("row"))
        # a partition at a time: of long texts all places are two hundred megabytes, of which the driver holds one copy
        rows = sorted(once.select("id", "row.*").toLocalIterator(), key=lambda r: r["id"])
    order = np.random.default_rng(7).permutation(len(rows))
    return Ftrl().fit([(np.frombuffer(rows[i]["place"], np.int32), np.frombuffer(rows[i]["value"], np.float32), rows[i]["label"]) for i in order.tolist()])


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """A row for each row: ``row`` (a struct of the carried columns, all by default) and ``score``."""
    rows = docs.select((whole_row(docs.select(*[F.col(f"`{c}`") for c in carry])) if carry else whole_row(docs)).alias("row"), F.col(f"`{text_col}`").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = sent.value
        of, place, value = features(batch.column("text"))
        total = np.bincount(of, weights=w[place] * value, minlength=batch.num_rows) + w[-1]
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], names=["row", "score"])

    return map_texts(rows, kernel, StructType([rows.schema["row"], StructField("score", DoubleType())]), "text")


def keep(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", least: float = 0.7) -> DataFrame:
    """The rows of docs scored at least ``least``, with all their columns. corpus: where labelled texts are read."""
    weights = train(docs if corpus is None else corpus, labels, id_col, text_col)
    return score(docs, weights, text_col).where(F.col("score") >= least).select("row.*")
