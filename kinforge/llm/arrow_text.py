"""Helpers for operators that read texts as Arrow batches in Python workers."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a kernel sees at once; longer single texts are seen alone.
CHUNK_BYTES = 1 << 20
#: Bytes of a batch that Spark sends to a Python worker; a longer row is sent alone.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
#: Rows that Spark's Parquet reader holds at once: all their texts are one array, which is doubled as it grows.
READ_SETTING, READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize", 64
#: The six characters of [\x20\x09-\x0D]; they separate words, as bytes.split() does.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def whole_row(df: DataFrame) -> Column:
    """All columns of df as one struct, so that added columns can't clash with them."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array, one text after another, and len + 1 offsets. Null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    base, end = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, dtype=np.uint8)[base:end] if data is not None and end > base else np.zeros(0, np.uint8)
    return raw, offsets - base


def pieces(batch: pa.RecordBatch, text_of: Callable[[pa.RecordBatch], pa.Array], chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most chunk_bytes of text each, or one row."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(text_of(batch)), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + chunk_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def release() -> None:
    """Give memory that a task has freed back to the system, so that idle Python workers hold little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def bound_reads(spark: SparkSession) -> None:
    """From here on the session reads Parquet few rows at a time: 4,096 texts of a hundred kilobytes fit in no task."""
    if int(spark.conf.get(READ_SETTING)) > READ_ROWS:
        spark.conf.set(READ_SETTING, READ_ROWS)


def map_texts(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str, text: str, chunk_bytes: int = CHUNK_BYTES, done: Callable[[], None] | None = None) -> DataFrame:
    """Run kernel over df's batches, cut by bytes of the column text; done is called when a task ends.

    The session's Arrow batches and reads are bounded from here on, as a batch of ten thousand long texts fits in no task.
    """
    bound_reads(df.sparkSession)
    conf = df.sparkSession.conf
    told = conf.get(BATCH_SETTING).removesuffix("b")  # a number of bytes unless the user gave it a unit
    if told.isdigit() and int(told) > BATCH_BYTES:
        conf.set(BATCH_SETTING, BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in pieces(batch, lambda b: b.column(text), chunk_bytes):
                    yield kernel(part)
        finally:
            if done:
                done()
            release()

    return df.mapInArrow(run, schema)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Within it, what is run sends Python workers batches of at most size bytes or one row."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... of each run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lengths)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and text number of each word [^\\x20\\x09-\\x0D]+ of the texts."""
    inside = ~SPACE[raw]
    if not len(raw):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(raw))]
    first[cut] = inside[cut]  # a text's first character starts a word even if the text before ends in one
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand."""
    up, down = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class TokenMemory(dict):
    """Token ids of strings that were met before, by a number each.

    encode: from a list of new strings to their ids, one string after another, and each one's number of ids.
    Above ``most`` strings it forgets those met least, half of them at least, so its size is bounded; operators
    reset it when a task ends.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int):
        super().__init__()
        self.encode, self.most = encode, most
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list = []
        self.flat = np.zeros(0, np.int32)
        self.lengths, self.starts, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _forget(self) -> None:
        least = 2
        while (self.met >= least).sum() > self.most // 2:
            least *= 2
        kept = np.flatnonzero(self.met >= least)
        flags = (self.met >= least).tolist()
        words = [w for w, on in zip(self, flags, strict=True) if on]  # a dict keeps its order, so numbers are places
        self.flat = self.flat[spread(self.starts[kept], self.lengths[kept])]
        self.lengths, self.met = self.lengths[kept], self.met[kept] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.clear()
        self.update(zip(words, range(len(words)), strict=True))

    def __missing__(self, word) -> int:
        self[word] = code = len(self)
        self.new.append(word)
        return code

    def codes(self, words: list[list]) -> list[np.ndarray]:
        """The numbers of the strings of each list; ids_of and lengths take them until the next call."""
        if len(self) > self.most:
            self._forget()
        get = self.__getitem__
        codes = [np.fromiter(map(get, w), np.int64, len(w)) for w in words]
        if self.new:
            new, self.new = self.new, []
            flat, lengths = self.encode(new)
            self.flat, self.lengths = np.concatenate([self.flat, flat]), np.concatenate([self.lengths, lengths])
            self.starts = np.cumsum(self.lengths) - self.lengths
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        if codes:
            self.met += np.bincount(np.concatenate(codes), minlength=len(self.met)).astype(np.int32)
        return codes

    def ids_of(self, codes: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.starts[codes], self.lengths[codes])]


def lists_to_flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """What TokenMemory's encode returns, from lists of ids."""
    return np.fromiter((i for x in lists for i in x), np.int32), np.fromiter(map(len, lists), np.int64, len(lists))
