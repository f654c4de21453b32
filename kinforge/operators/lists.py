"""Pairs as lists: the candidates of a record and source as gaps between numbers, and their masks, some two bytes a pair.

An id is its prefix and a number, which are its last digits, 18 at most; a list has the ids of one prefix and number of
digits (``width``), in order. An id that ends in no digit is a prefix with width 0. Gaps and masks are written by seven
bits a byte, the lowest first, where all bytes of a value but its last have the highest bit set.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PROVENANCE

KEY = ["s1_id", "source", "prefix", "width"]
LIST = "s1_id string, source string, prefix string, width int, n long, gaps binary, masks binary"
#: Pairs that are read out at once, about, and bytes of lists that Spark sends to a Python worker at once.
AT_ONCE = 1 << 18
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
DIGITS = "[0-9]{0,18}"


def split(cand_id: Column) -> tuple[Column, Column, Column]:
    """Prefix, width and number of an id."""
    digits = F.regexp_extract(cand_id, rf"({DIGITS})\z", 1)
    width = F.coalesce(F.length(digits), F.lit(0))
    return F.substr(cand_id, F.lit(1), F.length(cand_id) - width), width, F.when(width > 0, digits.cast("long")).otherwise(F.lit(0).cast("long"))


def split_all(ids: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Different prefixes and their widths; the number of each id's, and its number."""
    forms: dict[tuple[str | None, int], int] = {}
    last = re.compile(rf"{DIGITS}\Z")
    of, number = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for i, x in enumerate(ids.to_pylist()):
        digits = last.search(x)[0] if x else ""
        of[i] = forms.setdefault((x[: len(x) - len(digits)] if x is not None else None, len(digits)), len(forms))
        number[i] = int(digits or 0)
    return pa.array([p for p, _ in forms], pa.string()), np.array([w for _, w in forms], np.int32), of, number


def cand_id() -> Column:
    """The id of prefix, width and number."""
    return F.when(F.col("width") == 0, F.col("prefix")).otherwise(F.concat("prefix", F.lpad(F.col("number").cast("string"), F.col("width"), F.lit("0"))))


def _write(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """A binary value of n values each."""
    if values.max(initial=0) < 128:
        return _of_bytes(values.astype(np.uint8), n)
    size = np.ones(len(values), np.int64)
    rest = values >> 7
    while rest.any():
        size += rest > 0
        rest >>= 7
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        which = slice(None) if k == 0 else np.flatnonzero(size > k)
        out[(ends - size)[which] + k] = (values[which] >> (7 * k) & 127) | np.where(size[which] > k + 1, 128, 0)
    offsets = np.append(0, ends)[np.append(0, np.cumsum(n))].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _bytes(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)


def _of_bytes(data: np.ndarray, n: np.ndarray) -> pa.Array:
    """A binary value of n bytes each."""
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, np.cumsum(n)).astype(np.int32)), pa.py_buffer(data)])


def _read(column: pa.Array) -> np.ndarray:
    data = _bytes(column)
    if data.max(initial=0) < 128:
        return data.astype(np.int64)
    ends = np.flatnonzero(data < 128)
    size = np.diff(ends, prepend=-1)
    values = (data[ends - size + 1] & 127).astype(np.int64)
    for k in range(1, int(size.max(initial=1))):
        which = np.flatnonzero(size > k)
        values[which] |= (data[ends[which] - size[which] + 1 + k] & 127).astype(np.int64) << (7 * k)
    return values


def pack(n: np.ndarray, number: np.ndarray, mask: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """gaps and masks of lists of n pairs each."""
    gap = np.diff(number, prepend=0)
    starts = (np.cumsum(n) - n)[n > 0]
    gap[starts] = number[starts]
    return _write(gap, n), _write(mask.astype(np.int64) & 0xFFFFFFFF, n)


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, number and mask of each pair."""
    n = np.asarray(batch.column("n"))
    gap, mask = _read(batch.column("gaps")), _read(batch.column("masks"))
    total = np.cumsum(gap)
    starts = np.minimum(np.cumsum(n) - n, max(0, len(gap) - 1))
    before = (total - gap)[starts] if len(gap) else np.zeros(len(n), np.int64)
    return np.repeat(np.arange(len(n)), n), total - np.repeat(before, n), mask.astype(np.uint32).view(np.int32)


def _parts(batch: pa.RecordBatch, new: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of about AT_ONCE pairs, cut only where new is set."""
    ends, at = np.cumsum(np.asarray(batch.column("n"))), 0
    cuts = np.append(np.flatnonzero(new), batch.num_rows)
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, side="right"))
        later = int(np.searchsorted(cuts, at, side="right"))
        stop = int(cuts[max(later, int(np.searchsorted(cuts, stop, side="right")) - 1)])
        yield batch.slice(at, stop - at)
        at = stop


def _news(batch: pa.RecordBatch) -> np.ndarray:
    """Where the KEY differs from that of the row before."""
    out = np.ones(batch.num_rows, bool)
    out[1:] = False
    for c in map(batch.column, KEY):
        a, b = c[1:], c[:-1]
        same = pc.fill_null(pc.equal(a, b), False)
        out[1:] |= ~(np.asarray(same) | np.asarray(pc.and_(a.is_null(), b.is_null())))
    return out


def _joined(group: np.ndarray, number: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs in order of group and number, the masks of equal ones joined by or."""
    bits, low = int(number.max(initial=0)).bit_length(), int(mask.max(initial=0)).bit_length()
    if mask.min(initial=0) >= 0 and int(group.max(initial=0)).bit_length() + bits + low < 63:  # one number says all
        code = (group << bits | number) << low | mask
        code.sort()
        pair, mask = code >> low, (code & ((1 << low) - 1)).astype(np.int32)
        group, number = pair >> bits, pair & ((1 << bits) - 1)
    else:
        order = np.lexsort((number, group))
        group, number, mask = group[order], number[order], mask[order]
    first = np.ones(len(group), bool)
    first[1:] = (group[1:] != group[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(first)
    return group[first], number[first], np.bitwise_or.reduceat(mask, first) if len(first) else mask


def _lists(rows: pa.RecordBatch, n: np.ndarray, number: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    gaps, masks = pack(n, number, mask)
    return pa.RecordBatch.from_arrays([*(rows.column(c) for c in KEY), pa.array(n), gaps, masks], names=[x.split()[0] for x in LIST.split(", ")])


def _run(df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow; the session's Arrow batches are bounded from here on, as ten thousand long lists fit in no task."""
    from .matching import released

    conf = df.sparkSession.conf
    told = conf.get(BATCH_SETTING).removesuffix("b")
    if told.lstrip("-").isdigit() and not 0 < int(told) <= BATCH_BYTES:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return df.mapInArrow(released(kernel), schema)


def of_pairs(pairs: DataFrame) -> DataFrame:
    """Lists of s1_id, source, cand_id and provenance: of the rows that come together, so a pair may be in several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.zeros(batch.num_rows, np.int64)
            for c in KEY:
                coded = batch.column(c).dictionary_encode()
                code = np.asarray(coded.indices.fill_null(len(coded.dictionary))).astype(np.int64)
                group = np.unique(group * (len(coded.dictionary) + 1) + code, return_inverse=True)[1]
            if batch.num_rows:
                one = np.unique(group, return_index=True)[1]
                group, number, mask = _joined(group, np.asarray(batch.column("number")), np.asarray(batch.column("provenance")))
                yield _lists(batch.take(pa.array(one)), np.bincount(group, minlength=len(one)), number, mask)

    prefix, width, number = split(F.col("cand_id"))
    mask = F.coalesce(F.col("provenance").cast("int"), F.lit(0))
    return _run(pairs.select("s1_id", "source", prefix.alias("prefix"), width.alias("width"), number.alias("number"), mask.alias("provenance")), run, LIST)


def masked(lists: DataFrame, bits: int) -> DataFrame:
    """The same pairs with these bits of their masks only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, data = np.asarray(batch.column("n")), _bytes(batch.column("masks"))
            cut = _of_bytes(data & (bits & 127), n) if data.max(initial=0) < 128 else _write(_read(batch.column("masks")) & (bits & 0xFFFFFFFF), n)
            yield batch.set_column(batch.schema.get_field_index("masks"), "masks", cut)

    return _run(lists, run, LIST)


def merged(lists: DataFrame) -> DataFrame:
    """One list for each KEY; the masks of a pair that is in several are joined by or."""

    def one_each(part: pa.RecordBatch) -> pa.RecordBatch:
        new = _news(part)
        if new.all():
            return part
        if part.num_rows % 2 == 0 and new[::2].all() and not new[1::2].any():  # a batch that came again, with other bits
            one, two = (part.take(pa.array(np.arange(k, part.num_rows, 2))) for k in (0, 1))
            a, b = _bytes(one.column("masks")), _bytes(two.column("masks"))
            if max(a.max(initial=0), b.max(initial=0)) < 128 and one.column("gaps").equals(two.column("gaps")):
                return one.set_column(one.schema.get_field_index("masks"), "masks", _of_bytes(a | b, np.asarray(one.column("n"))))
        row, number, mask = unpack(part)
        group, number, mask = _joined((np.cumsum(new) - 1)[row], number, mask)
        first = np.flatnonzero(new)
        return _lists(part.take(pa.array(first)), np.bincount(group, minlength=len(first)), number, mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            new = _news(batch)
            last = int(np.flatnonzero(new)[-1])  # more rows of this key may come
            held = one_each(batch.slice(last))
            for part in _parts(batch.slice(0, last), new[:last]) if last else ():
                yield one_each(part)
        if held is not None:
            yield held

    return _run(lists.repartition("s1_id", "source").sortWithinPartitions(*KEY), run, LIST)


def pairs(lists: DataFrame, most: int | None = None) -> DataFrame:
    """s1_id, source, cand_id and provenance of merged lists. With most only the best of each list, as ranking.rank has
    them: ids of one prefix and width are in the order of their numbers."""
    order = ["rare_name_token", "address_number_location", "address_token", "compact_char_ngram", "missing_country_fallback", "cross_country_high_specificity"]

    def tier(mask: np.ndarray) -> np.ndarray:
        out = (mask & PROVENANCE["exact_name"]).astype(np.int64) << 6 | np.bitwise_count(mask.view(np.uint32))
        for p in order:
            out = out << 1 | (mask & PROVENANCE[p] > 0)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, np.ones(batch.num_rows, bool)):
                row, number, mask = unpack(part)
                if most is not None:
                    bits = len(row).bit_length()  # tiers have 13 bits; places come last, so numbers stay in order
                    by = (row << 13 | (1 << 13) - 1 - tier(mask)) << bits | np.arange(len(row))
                    by.sort()
                    by &= (1 << bits) - 1
                    n = np.asarray(part.column("n"))
                    by = by[np.arange(len(by)) - (np.cumsum(n) - n)[row] < most]
                    row, number, mask = row[by], number[by], mask[by]
                for a in range(0, len(row), 1 << 17):
                    i, j = pa.array(row[a : a + (1 << 17)]), slice(a, a + (1 << 17))
                    yield pa.RecordBatch.from_arrays([*(part.column(c).take(i) for c in KEY), pa.array(number[j]), pa.array(mask[j])], names=[*KEY, "number", "provenance"])

    rows = _run(lists, run, "s1_id string, source string, prefix string, width int, number long, provenance int")
    return rows.select("s1_id", "source", cand_id().alias("cand_id"), "provenance")
