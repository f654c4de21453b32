"""Best-fit packing with large-item matching.

Documents are tokenised, ended by one id and, if longer than the capacity, cut into pieces. A piece as long as the
capacity is a sequence of its own. How many pieces there are of each other length is all that packing depends on, so
it is planned on the counts (under capacity numbers, whatever the corpus): pieces above a third of the capacity are
matched greedily, at most two to a bin, the longest first, each with the longest that still fits; smaller ones,
longest first, go where they fit best in the gaps that remain. The plan says where the k-th piece of a length goes.
Pieces get their k from a rank within a hash class of their length, of about ``CLASS_ROWS`` rows, and the rows of the
classes before, so a length that a third of all rows have is ranked by as many tasks as it needs.

Tokens come from a public vocabulary that drops white space: its tokens never reach over the six ASCII white
space characters, so words are encoded once and remembered.

Defined results: a null text is empty, and an empty one is its end id alone; whole texts are cut, however long; of
pieces of equal length any may take a place; rows that repeat are packed each, null ids too; an empty table gives an
empty result; only the id column is carried.
"""

from __future__ import annotations

import bisect
import json
import os
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .arrow_text import TokenMemory, lists_to_flat, map_texts, small_batches, spread, whole_row
from .bpe import PairTable, merge_rows
from .staging import stage

CAPACITY, END_ID = 2048, 0
#: Rows of one length that a task ranks, about.
CLASS_ROWS = 1 << 10
#: Words, and pieces of words, remembered by a task at most.
REMEMBERED = 600_000
#: Bytes of text that are tokenised at once.
CHUNK_BYTES = 1 << 21


#: What the vocabulary's file cuts lowered text into, and the single spaces that words are joined by here.
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+| ")
#: Code points below this go through matrices, but for those in _ODD.
_LATIN_END = 0x250
#: What lower() and NFC may not treat letter by letter or take beyond _LATIN_END, and where special tokens begin.
_ODD = regex.compile("[" + "".join(f"\\u{n:04x}" for n in range(_LATIN_END) if len(chr(n).lower()) > 1 or ord(chr(n).lower()) >= _LATIN_END) + rf"\u{_LATIN_END:04x}-\U0010FFFF]|<\|")


class Words:
    """Token ids of texts, by the words they are of; for words in Latin script by matrices of merges, for others
    by the vocabulary's own library."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self.path = path
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocabulary[a + b] for a, b in merges]
        if merged != sorted(merged):
            raise ValueError("the ids of merges must rise with their ranks")
        self.pairs = PairTable(*np.array([(vocabulary[a], vocabulary[b], c) for (a, b), c in zip(merges, merged, strict=True)], dtype=np.int64).T)
        shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.first = np.zeros((2, 256), dtype=np.int32)  # ids of bytes inside a piece, and at its end
        for c in map(chr, range(_LATIN_END)):
            for byte, letter in zip(c.encode(), shown.pre_tokenize_str(c)[0][0], strict=True):
                self.first[:, byte] = vocabulary[letter], vocabulary[letter + model["end_of_word_suffix"]]
        self.piece_memory = TokenMemory(self._merge, REMEMBERED // 2)
        self.memory = TokenMemory(self._encode, REMEMBERED)

    @cached_property
    def model(self):
        """The vocabulary in its own library; it is loaded only where a word needs it."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The space, which separates words here, has no ids."""
        raw = ["" if p == " " else p for p in pieces] if " " in pieces else pieces
        raw = [p.encode() for p in raw]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ids = self.first[0, data]
        ends = (np.cumsum(lengths) - 1)[lengths > 0]
        ids[ends] = self.first[1, data[ends]]
        return merge_rows(self.pairs, ids, lengths)

    def _plain(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words joined by spaces, and each word's number of ids."""
        pieces = _CUT.findall(text.lower())
        codes, space = self.piece_memory.codes([pieces, [" "]])
        word = np.cumsum(codes == space)
        sizes = np.bincount(word, weights=self.piece_memory.lengths[codes], minlength=text.count(" ") + 1).astype(np.int64)
        return self.piece_memory.ids_of(codes), sizes

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = b" ".join(words).decode()
        if not _ODD.search(text):
            return self._plain(text)
        texts = text.split(" ")
        odd = np.fromiter((_ODD.search(t) is not None for t in texts), bool, len(texts))
        sizes = np.zeros(len(texts), dtype=np.int64)
        mine, other = np.flatnonzero(~odd), np.flatnonzero(odd)
        flat = np.zeros(0, np.int32)
        if len(mine):
            flat, sizes[mine] = self._plain(" ".join([texts[i] for i in mine.tolist()]))
        ids, sizes[other] = lists_to_flat([e.ids for e in self.model.encode_batch([texts[i] for i in other.tolist()], add_special_tokens=False)])
        starts = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), dtype=np.int32)
        out[spread(starts[mine], sizes[mine])] = flat
        out[spread(starts[other], sizes[other])] = ids
        return out, sizes

    def forget(self) -> None:
        self.memory.reset()
        self.piece_memory.reset()

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        return [self.memory.ids_of(codes) for codes in self.memory.codes([t.split() for t in texts])]


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def tokenise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.append(x, np.int32(END_ID)) for x in _words(path).encode([(t or "").encode() for t in batch.column("text").to_pylist()])]
        n = np.array([-(-len(x) // capacity) for x in ids], dtype=np.int64)
        piece = spread(np.zeros(len(n), np.int64), n)
        cut = [x[a : a + capacity] for x in ids for a in range(0, len(x), capacity)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()), pa.array([len(x) for x in cut], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in cut], pa.binary())],
            names=["doc_id", "piece", "start", "length", "ids"],
        )

    schema = StructType([rows.schema["doc_id"], StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType())])
    return map_texts(rows, kernel, schema, "text", CHUNK_BYTES, done=lambda: _words(path).forget())


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first k, first bin, pieces of it in each bin, offset in the bin), sorted: from its first k
    on, the k-th piece of the length goes to bin first + (k - first k) // each, behind those before it."""
    left = {n: c for n, c in counts.items() if c > 0}
    given = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: list[int] = []  # sorted
    open_bins: dict[int, list[tuple[int, int]]] = {}  # by gap: first bin and number of bins
    bins = 0

    def put(length: int, first: int, n: int, each: int, offset: int, pieces: int) -> None:
        rows.append((length, given[length], first, each, offset))
        given[length] += pieces
        left[length] -= pieces

    def leave(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in open_bins:
                bisect.insort(gaps, gap)
            open_bins.setdefault(gap, []).append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            k = bisect.bisect_right(large, min(capacity - length, length)) - 1
            while k >= 0 and (left[large[k]] < 2 if large[k] == length else not left[large[k]]):
                k -= 1
            if k < 0:
                n = left[length]
                put(length, bins, n, 1, 0, n)
                leave(capacity - length, bins, n)
            elif large[k] == length:
                n = left[length] // 2
                put(length, bins, n, 2, 0, 2 * n)
                leave(capacity - 2 * length, bins, n)
            else:
                n = min(left[length], left[large[k]])
                put(length, bins, n, 1, 0, n)
                put(large[k], bins, n, 1, length, n)
                leave(capacity - length - large[k], bins, n)
            bins += n
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while c := left[length]:
            k = bisect.bisect_left(gaps, length)
            if k < len(gaps):
                gap = gaps[k]
                first, n = open_bins[gap].pop()
                if not open_bins[gap]:
                    del open_bins[gap], gaps[k]
            else:
                gap, first, n = capacity, bins, -(-c // (capacity // length))
                bins += n
            each = gap // length
            full = min(n, c // each)
            if full:
                put(length, first, full, each, capacity - gap, full * each)
                leave(gap - each * length, first, full)
            if full < n:
                rest = min(left[length], each)
                if rest:
                    put(length, first + full, 1, rest, capacity - gap, rest)
                    leave(gap - rest * length, first + full, 1)
                leave(gap, first + full + (rest > 0), n - full - (rest > 0))
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, start, length and others) with sequence_id and offset. It is read more than once:
    stage it before. Sequences of one whole piece have negative numbers."""
    spark = pieces.sparkSession
    whole = pieces.where(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity)
    counts = {r["length"]: r["count"] for r in part.groupBy("length").count().collect()}  # under capacity rows
    steps = spark.sparkContext.broadcast(plan(counts, capacity))
    classes = spark.createDataFrame([(n, c // CLASS_ROWS + 1) for n, c in counts.items()], "length long, classes long")
    dealt = part.select(whole_row(part).alias("row"), "length", F.xxhash64("doc_id", "piece", "start").alias("hash")).join(F.broadcast(classes), "length")
    dealt = dealt.select("row", "length", F.pmod("hash", "classes").alias("class"))
    sizes = dealt.groupBy("length", "class").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "class", (F.sum("n").over(Window.partitionBy("length").orderBy("class")) - F.col("n")).alias("before"))
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("length", "class").orderBy("row.doc_id", "row.piece", "row.start")))
    ranked = ranked.join(stage(before, "class-offsets"), ["length", "class"]).select("row", "length", (F.col("before") + F.col("rank") - 1).alias("k"))

    def place(batches):
        table = steps.value
        key = table[:, 0] << 44 | table[:, 1] if len(table) else np.zeros(0, np.int64)
        for batch in batches:
            length, k = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "k"))
            step = table[np.searchsorted(key, length << 44 | k, side="right") - 1]
            at = k - step[:, 1]
            row = batch.column("row")
            yield pa.RecordBatch.from_arrays([*row.flatten(), pa.array(step[:, 2] + at // step[:, 3]), pa.array(step[:, 4] + at % step[:, 3] * length)], names=[*(f.name for f in row.type), "sequence_id", "offset"])

    return whole.unionByName(ranked.mapInArrow(place, StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids on demand."""
    pieces = tokenise(docs, id_col, text_col, capacity, path).withColumn("ids_crc32", F.crc32("ids"))
    with small_batches(docs.sparkSession):
        staged = stage(pieces if with_ids else pieces.drop("ids"), "pieces")
    return pack(staged, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence (binary), from pieces packed with their ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("parts")).select("sequence_id", "n_tokens", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))
