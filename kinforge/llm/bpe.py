"""Byte-level BPE by rounds over padded matrices.

A text is cut by the vocabulary's pattern. Pieces not met before are put, by length, into numpy matrices of one
row per piece, padded to the bucket's width. Each round every row merges its leftmost pair of least rank: the
ranks of a row's neighbours are kept beside it, the merged place takes the new id, the row's tail moves one
place left, and only the two pairs at the merged place are looked up again, in an open-addressing hash table of
all mergeable pairs. Rows without a mergeable pair leave the matrix. Pieces of over ``LONGEST`` bytes, for which
rounds over a matrix would take quadratic time, go through the same merges with a heap. A piece that is a token
itself is that token, as in the rank file's own library.

Defined results: null and empty texts have no tokens; rows that repeat have equal tokens; ids without a token
can't be decoded and raise KeyError; an empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .arrow_text import TokenMemory, map_texts, spread, whole_row

LONGEST = 2048
#: Elements of a matrix, and pieces remembered by a task, at most.
ELEMENTS, REMEMBERED = 1 << 20, 400_000
NONE = np.int32(2**31 - 1)


class PairTable:
    """Open-addressing hash table from (left id, right id) to the id of the merged token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(2 * len(left)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        key = left.astype(np.int64) << 32 | right
        slot, todo = self._slot(key), np.arange(len(key))
        self.probes = 0
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = key[free]  # of those that want one slot, the last gets it
            won = free[self.keys[slot[free]] == key[free]]
            self.values[slot[won]] = merged[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = slot[todo] + 1 & self.mask
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, which are also their ranks; NONE where a pair can't merge (or an id is negative)."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        flat = key.ravel()
        out = np.full(flat.shape, NONE, dtype=np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(flat[todo])
        for _ in range(self.probes):
            found = self.keys[slot]
            hit = found == flat[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            if not on.any():
                break
            todo, slot = todo[on], slot[on] + 1 & self.mask
        return out.reshape(key.shape)


def merge_matrix(pairs: PairTable, ids: np.ndarray) -> np.ndarray:
    """Rows of ids, padded by -1, with all merges done."""
    rank = pairs.ranks(ids[:, :-1], ids[:, 1:])
    out = np.full(ids.shape, -1, dtype=np.int32)
    row = np.arange(len(ids))
    while len(row):
        if not rank.shape[1]:
            out[row, :1] = ids
            break
        here = np.arange(len(row))
        at = rank.argmin(axis=1)
        least = rank[here, at]
        over = least == NONE
        if over.any():
            out[row[over], : ids.shape[1]] = ids[over]
            on = ~over
            row, at, least = row[on], at[on], least[on]
            width = max(2, int((ids[on] >= 0).sum(axis=1).max(initial=0)))  # compaction: columns that no row needs any more go
            ids, rank = ids[on, :width], rank[on, : width - 1]
            here = here[: len(row)]
        ids[here, at] = least
        later = np.arange(ids.shape[1] - 1) > at[:, None]
        ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
        ids[:, -1] = -1
        rank[:, :-1] = np.where(later[:, :-1] | (np.arange(ids.shape[1] - 2) == at[:, None]), rank[:, 1:], rank[:, :-1])
        rank[:, -1] = NONE
        inner = at < rank.shape[1]
        rank[here[inner], at[inner]] = pairs.ranks(ids[here[inner], at[inner]], ids[here[inner], at[inner] + 1])
        inner = at > 0
        rank[here[inner], at[inner] - 1] = pairs.ranks(ids[here[inner], at[inner] - 1], ids[here[inner], at[inner]])
    return out


def merge_long(pairs: PairTable, ids: np.ndarray) -> np.ndarray:
    """The same merges for one long row, with a heap."""
    now = ids.tolist()
    n = len(now)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, now[i], now[i + 1]) for i, r in enumerate(pairs.ranks(ids[:-1], ids[1:]).tolist()) if r != NONE]
    heapq.heapify(heap)

    def push(i: int) -> None:
        if i >= 0 and (j := after[i]) < n:
            r = int(pairs.ranks(np.array([now[i]]), np.array([now[j]]))[0])
            if r != NONE:
                heapq.heappush(heap, (r, i, now[i], now[j]))

    while heap:
        r, i, a, b = heapq.heappop(heap)
        if now[i] != a or (j := after[i]) >= n or now[j] != b:
            continue
        now[i], now[j], after[i] = r, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        push(before[i])
        push(i)
    return np.array([x for x in now if x >= 0], dtype=np.int32)


def merge_rows(pairs: PairTable, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All merges of rows of ids given one after another, by buckets of like lengths; in the same form."""
    starts = np.cumsum(lengths) - lengths
    sizes = lengths.copy()
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for k in np.flatnonzero(lengths > LONGEST).tolist():
        ids = merge_long(pairs, flat[starts[k] : starts[k] + lengths[k]])
        sizes[k] = len(ids)
        found.append((np.array([k]), ids))
    low = 0
    while low < min(LONGEST, int(lengths.max(initial=0))):
        high = max(low + 2, low * 3 // 2)
        members = np.flatnonzero((lengths > low) & (lengths <= high) & (lengths <= LONGEST))
        step = max(1, ELEMENTS // high)
        for a in range(0, len(members), step):
            part = members[a : a + step]
            ids = np.full((len(part), int(lengths[part].max())), -1, dtype=np.int32)
            ids[np.arange(ids.shape[1]) < lengths[part, None]] = flat[spread(starts[part], lengths[part])]
            ids = merge_matrix(pairs, ids)
            sizes[part] = (ids >= 0).sum(axis=1)
            found.append((part, ids[ids >= 0]))
        low = high
    ends = np.cumsum(sizes)
    out = np.zeros(int(sizes.sum()), dtype=np.int32)
    for part, ids in found:
        out[spread(ends[part] - sizes[part], sizes[part])] = ids
    return out, sizes


class BytePairEncoding:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.pattern = regex.compile(pattern)
        self.byte_id = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [(self.ids[t[:k]], self.ids[t[k:]], i) for t, i in self.ids.items() for k in range(1, len(t)) if t[:k] in self.ids and t[k:] in self.ids]
        self.pairs = PairTable(*np.array(pairs, dtype=np.int64).T)
        size = max(self.tokens) + 1
        self.token_length = np.array([len(self.tokens.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.memory = TokenMemory(self.merge, REMEMBERED)

    def merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one piece after another, and how many each has."""
        raw = [p.encode() for p in pieces]
        whole = [self.ids.get(p, -1) for p in raw]
        rows = [self.byte_id[np.frombuffer(p, dtype=np.uint8)] if w < 0 else np.array([w], np.int32) for p, w in zip(raw, whole, strict=True)]
        return merge_rows(self.pairs, np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The token ids of each text."""
        return [self.memory.ids_of(codes) for codes in self.memory.codes([self.pattern.findall(t) for t in texts])]

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.max() >= len(self.token_length) or (self.token_length[ids] == 0).any()):
            raise KeyError("an id has no token")
        parts = (ids[a : a + ELEMENTS] for a in range(0, len(ids), ELEMENTS))
        return b"".join(self.token_bytes[spread(self.token_start[p], self.token_length[p])].tobytes() for p in parts)


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> BytePairEncoding:
    return BytePairEncoding(path, pattern)


def _vocabulary(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path is None or pattern is None:
        import public_tokenizers

        return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    return path, pattern


def encode(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``row`` (a struct of the carried columns, all by default), ``n_tokens`` and ``ids`` (binary: the ids as
    little-endian unsigned 32-bit integers)."""
    where = _vocabulary(path, pattern)
    rows = docs.select((whole_row(docs.select(*[F.col(f"`{c}`") for c in carry])) if carry else whole_row(docs)).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _encoding(*where).encode([t or "" for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], names=["row", "n_tokens", "ids"])

    return map_texts(rows, kernel, StructType([rows.schema["row"], StructField("n_tokens", LongType()), StructField("ids", BinaryType())]), "text", done=lambda: _encoding(*where).memory.reset())


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The result of ``encode`` with ``decoded`` (binary: the bytes of the tokens)."""
    where = _vocabulary(path, pattern)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [_encoding(*where).decode(np.frombuffer(x or b"", dtype="<u4").astype(np.int64)) for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return map_texts(encoded, kernel, StructType([*encoded.schema, StructField("decoded", BinaryType())]), "ids", 4 << 20)
