"""All passes at once: the pairs of a record are made where its whole source's postings are, as arrays of numbers.

A cell is one source of candidates and one share of the records that ask. Its candidates come first and become one
sorted array of postings by key, country and candidate; what a key's frequency, an intersection of two blocks or the
records of other countries decide is read off that array. The records then pass in bounded batches, and each pair leaves
with all its bits, so pairs are neither shuffled nor written. Keys are told apart by 64-bit hashes: among five million
different keys the chance that any two meet is below one in a million. A task holds the postings of one source (some 20
bytes for each key of each candidate); every share of the records reads them once.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PROVENANCE, BlockingConfig
from . import lists, postings

FAMILIES = (*postings.FAMILIES, "whole")
NAME, ADDRESS, PLACE, NGRAM, WHOLE = range(5)
#: Places of the bits that are set by passes which aren't a family's.
EXACT, MISSING, CROSS = (PROVENANCE[p].bit_length() - 1 for p in ("exact_name", "missing_country_fallback", "cross_country_high_specificity"))
OF_FAMILY = np.array([PROVENANCE[postings.PASS_OF[f]].bit_length() - 1 for f in postings.FAMILIES])
#: The pass of other countries by itself; see Crossing.
ALONE = frozenset({"cross"})
#: Countries by number: none, null, then those that are named.
NONE, NULL, KNOWN = 0, 1, 2
#: Records that ask in one cell at most, about; entries that are made at once; tokens of more records than FREQUENT are
#: looked up and not listed, in at most MARKED tables at a time.
SHARE, ENTRIES, FREQUENT, MARKED = 1 << 16, 1 << 19, 512, 128
ROW = "side int, cell int, id string, country string, " + ", ".join(f"k{i} array<long>" for i in range(len(FAMILIES))) + ", wanted array<string>"
PAIR = "s1_id string, source string, cand_id string, provenance int"
FOUND = "s1_id string, source string, generated long, masks array<struct<provenance: int, n: long>>, kept array<struct<cand_id: string, provenance: int, rank: int>>"
#: How many large blocks were refined, kept whole, or dropped as too frequent (name tokens only); see passes.Blocks.events.
EVENTS = ("refined", "retained", "filtered")


def release() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def released(run: Callable) -> Callable:
    """run, which gives the memory of a task back when it ends."""

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return all_of


def keyed(records: DataFrame, config: BlockingConfig, passes: frozenset[str] | None = None) -> DataFrame:
    """source, id, country and the hashed keys of each family, with the whole name as a family of its own. With passes, the
    families that these don't read are empty."""
    none = F.expr("cast(array() as array<bigint>)")

    def hashed(family: str) -> Column:
        if passes == ALONE and FAMILIES.index(family) not in (NAME, PLACE):
            return none
        return F.transform(F.array_distinct(postings.keys_of(family, config)), lambda k: F.xxhash64(F.lit(family), k))

    families = [hashed(f).alias(f"k{i}") for i, f in enumerate(postings.FAMILIES)]
    whole = F.when(F.col("name") != "", F.array(F.xxhash64(F.lit("whole"), "name"))).otherwise(none)
    return records.select("source", F.col("entity_id").alias("id"), "country", *families, whole.alias(f"k{WHOLE}"))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - at, lengths)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of a list column, the row of each, and its place in the row's list."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    return np.asarray(pc.list_flatten(column)), np.repeat(np.arange(len(column)), lengths), spread(np.zeros(len(column), np.int64), lengths)


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    out = np.ones(len(sorted_values), dtype=bool)
    out[1:] = sorted_values[1:] != sorted_values[:-1]
    return out


def _news(ids: pa.Array) -> np.ndarray:
    """Where an id differs from the one before."""
    out = np.ones(len(ids), dtype=bool)
    out[1:] = np.asarray(pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), True))
    return out


def scores() -> np.ndarray:
    """A number for each mask, higher where ranking.evidence_tier puts it first."""
    masks = np.arange(128)
    out = (masks & 1) << 3 | np.bitwise_count(masks)
    for p in ("rare_name_token", "address_number_location", "address_token", "compact_char_ngram", "missing_country_fallback", "cross_country_high_specificity"):
        out = out << 1 | (masks & PROVENANCE[p] > 0)
    return out.astype(np.int64)


class Index:
    """The candidates of a source, which come in the order of their ids."""

    def __init__(self, batches: list[pa.RecordBatch], config: BlockingConfig, passes: frozenset[str]):
        self.config, self.passes = config, passes
        ids = pa.concat_arrays([b.column("id") for b in batches])
        new = _news(ids)
        number = np.cumsum(new) - 1
        self.ids, self.repeated = ids.filter(pa.array(new)), not new.all()
        self.bits = max(1, int(len(self.ids)).bit_length())
        named = pa.concat_arrays([b.column("country") for b in batches])
        self.countries = {"": NONE, None: NULL}
        for c in pc.unique(named).to_pylist():
            self.countries.setdefault(c, len(self.countries))
        self.width = len(self.countries) + 1  # the last is for countries that no candidate has
        country = self.country(named)
        keys, rows = [], []
        for f in range(len(FAMILIES)):
            base = 0
            for b in batches:
                values, row, _ = _lists(b.column(f"k{f}"))
                row += base
                base += b.num_rows
                if f == NGRAM:  # as in postings.postings
                    values, row = values[country[row] >= KNOWN], row[country[row] >= KNOWN]
                keys.append(values)
                rows.append(row.astype(np.int32))
        batches.clear()
        keys, rows = np.concatenate(keys), np.concatenate(rows)
        order = np.argsort(keys)
        keys, rows = keys[order], rows[order]
        del order
        first = _firsts(keys)
        self.keys = keys[first]
        del keys
        block = (np.cumsum(first) - 1) * self.width + country[rows]
        order = np.lexsort((rows, block))
        block, self.cands = block[order], number[rows[order]].astype(np.int32)
        del order, rows
        starts = np.flatnonzero(_firsts(block))
        self.blocks, self.starts = block[starts], np.append(starts, len(block))
        first = np.arange(len(self.keys)) * self.width
        self.start, self.known = (self.starts[np.searchsorted(self.blocks, first + c)] for c in (NONE, KNOWN))
        self.end = np.append(self.start[1:], len(block))
        self.most = np.array([config.max_df(f, len(ids)) for f in postings.FAMILIES])
        self.marks: dict[int, np.ndarray] = {}

    def country(self, column: pa.Array) -> np.ndarray:
        coded = column.dictionary_encode()
        table = np.array([*(self.countries.get(c, self.width - 1) for c in coded.dictionary.to_pylist()), NULL])
        return table[np.asarray(coded.indices.fill_null(len(table) - 1))]

    def key(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def block(self, key: np.ndarray, country: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the block of a key in a country."""
        wanted = key * self.width + country
        at = np.minimum(np.searchsorted(self.blocks, wanted), len(self.blocks) - 1)
        return self.starts[at], np.where(self.blocks[at] == wanted, self.starts[at + 1] - self.starts[at], 0)

    def has(self, key: np.ndarray, cands: np.ndarray) -> np.ndarray:
        """Whether each candidate has each key. key is in order; each is looked up in a table of all candidates."""
        out = np.zeros(len(key), dtype=bool)
        cuts = np.append(np.flatnonzero(_firsts(key)), len(key))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            k = int(key[a])
            mark = self.marks.get(k)
            if mark is None:
                mark = np.zeros(len(self.ids), dtype=bool)
                mark[self.cands[self.start[k] : self.end[k]]] = True
                if len(self.marks) >= MARKED:
                    self.marks.pop(next(iter(self.marks)))
                self.marks[k] = mark
            out[a:b] = mark[cands[a:b]]
        return out

    def answer(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The first row of a part of batch, its number of rows, the row in it, candidate and mask of each pair, in
        the order of rows and candidates, and the EVENTS of each row."""
        if not len(self.keys):
            return
        country = self.country(batch.column("country"))
        asked = []  # of each family: row, place, key
        volume = np.ones(batch.num_rows, dtype=np.int64)
        for f in range(len(FAMILIES)):
            values, row, place = _lists(batch.column(f"k{f}"))
            key = self.key(values) if len(values) else np.zeros(0, np.int64)
            keep = key >= 0
            row, place, key = row[keep], place[keep], key[keep]
            asked.append((row, place, key))
            size = np.where(country[row] == NONE, self.end[key] - self.start[key], self.end[key] - self.known[key]) if f in (NAME, PLACE, WHOLE) else np.minimum(self.end[key] - self.start[key], self.most[f])
            volume += np.bincount(row, weights=size, minlength=batch.num_rows).astype(np.int64)
        ends, at = np.cumsum(volume), 0
        same = np.cumsum(_news(batch.column("id")))  # rows of one id come together, and are one record's
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENTRIES, side="right")))
            stop = int(np.searchsorted(same, same[stop - 1], side="right"))
            part = []
            for row, place, key in asked:
                a, b = np.searchsorted(row, [at, stop])
                part.append((row[a:b] - at, place[a:b], key[a:b]))
            events = np.zeros((stop - at, len(EVENTS)), dtype=np.int64)
            row, cand, mask = self._pairs(country[at:stop], part, events)
            if same[stop - 1] - same[at] < stop - at - 1:
                pair = np.searchsorted(same[at:stop], same[at:stop])[row] << self.bits | cand
                order = np.argsort(pair, kind="stable")
                pair, mask = pair[order], mask[order]
                first = np.flatnonzero(_firsts(pair))
                mask = np.bitwise_or.reduceat(mask, first) if len(first) else mask
                row, cand = pair[first] >> self.bits, pair[first] & ((1 << self.bits) - 1)
            yield at, stop - at, row, cand, mask, events
            at = stop

    def _pairs(self, country: np.ndarray, asked: list, events: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found: list[np.ndarray] = []  # row, candidate and bit in one number

        def add(row: np.ndarray, starts: np.ndarray, lengths: np.ndarray, bit) -> None:
            some = np.flatnonzero(lengths > 0)
            row, starts, lengths = row[some], starts[some], lengths[some]
            low = np.broadcast_to(bit, some.shape) if np.ndim(bit) == 0 else bit[some]
            found.append(np.repeat(row << (self.bits + 3) | low, lengths) | self.cands[spread(starts, lengths)].astype(np.int64) << 3)

        c = [country[row] for row, _, _ in asked]
        known = [x >= KNOWN for x in c]
        if "exact" in self.passes:
            row, _, key = asked[WHOLE]
            starts, n = self.block(key, c[WHOLE])
            add(row, starts, np.where(known[WHOLE], n, 0), EXACT)
        if "blocks" in self.passes:
            found += self._blocks([(row[k], place[k], key[k], x[k]) for (row, place, key), k, x in zip(asked[:WHOLE], known, c, strict=False)], events)
        if "missing" in self.passes:
            for f in (NAME, PLACE, WHOLE):
                row, _, key = asked[f]
                starts, n = self.block(key, np.full(len(key), NONE))
                add(row, starts, np.where(known[f] & ((f == WHOLE) | (n <= self.most[min(f, PLACE)])), n, 0), MISSING)
                add(row, self.start[key], np.where(c[f] == NONE, self.end[key] - self.start[key], 0), MISSING)
        if "cross" in self.passes:
            for f in (PLACE, WHOLE):
                row, _, key = (x[known[f]] for x in asked[f])
                few = np.ones(len(key), bool)
                starts, n, lengths = self._others(key, c[f][known[f]])
                if f == PLACE:
                    few = lengths.sum(axis=0) <= self.config.max_block_size
                for s, m in zip(starts, lengths, strict=True):
                    add(row, s, np.where(few, m, 0), CROSS)
            found.append(self._tokens(*(x[known[NAME]] for x in (asked[NAME][0], asked[NAME][2], c[NAME]))))
        all_found = np.concatenate([np.zeros(0, np.int64), *found])
        all_found.sort()
        all_found = all_found[_firsts(all_found)] if len(all_found) else all_found
        pair = all_found >> 3
        first = np.flatnonzero(_firsts(pair))
        masks = np.bitwise_or.reduceat(np.left_shift(1, all_found & 7).astype(np.uint8), first) if len(first) else np.zeros(0, np.uint8)
        pair = pair[first]
        return pair >> self.bits, pair & ((1 << self.bits) - 1), masks

    def _others(self, key: np.ndarray, country: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and lengths of a key's two runs of other known countries, before and after the own one."""
        own, n = self.block(key, country)
        own = np.where(n > 0, own, self.end[key])
        return np.stack([self.known[key], own + n]), n, np.stack([own - self.known[key], self.end[key] - own - n])

    def _tokens(self, row: np.ndarray, key: np.ndarray, country: np.ndarray) -> np.ndarray:
        """Pairs of different countries with enough tokens in common. Where that is two, who shares two shares one besides
        the most frequent, so this one's records aren't listed, but those found by one of the others are looked up in it."""
        least = self.config.cross_country_min_rare_tokens
        starts, _, lengths = self._others(key, country)
        size = lengths.sum(axis=0)
        order = np.lexsort((-size, row))
        top = np.zeros(len(row), dtype=bool)
        if least == 2 and len(row):
            top[order[_firsts(row[order])]] = True
            top &= size > FREQUENT
        most = np.full(int(row.max(initial=0)) + 1, -1)
        most[row[top]] = key[top]
        rest = np.flatnonzero(~top)
        code = []
        for s, m in zip(starts, lengths, strict=True):
            which = np.repeat(rest, m[rest])
            one = row[which] << self.bits | self.cands[spread(s[rest], m[rest])]
            code.append(one if not self.repeated else np.stack([one, key[which]], axis=1))
        code = np.concatenate(code)
        code = np.unique(code, axis=0)[:, 0].copy() if self.repeated else code
        code.sort()
        first = np.flatnonzero(_firsts(code))
        count = np.diff(np.append(first, len(code)))
        code = code[first]
        enough = count >= least
        if least == 2:
            single = np.flatnonzero(~enough)
            single = single[most[code[single] >> self.bits] >= 0]
            probe = most[code[single] >> self.bits]
            by_key = np.argsort(probe, kind="stable")
            got = self.has(probe[by_key], (code[single] & ((1 << self.bits) - 1))[by_key])
            enough[single[by_key[got]]] = True
        return code[enough] << 3 | CROSS

    def _blocks(self, asked: list, events: np.ndarray) -> list[np.ndarray]:
        """Pairs of the same-country passes; see passes.Blocks. events gets those of each row."""
        most = self.config.max_block_size
        parts = []
        for f, (row, place, key, country) in enumerate(asked):
            starts, n = self.block(key, country)
            ok = np.flatnonzero((n > 0) & (n <= self.most[f]))
            parts.append((row[ok] * WHOLE + f, place[ok], starts[ok], n[ok]))
            if f == NAME:
                events[:, 2] = np.bincount(row[n > self.most[f]], minlength=len(events))
        of, place, starts, n = (np.concatenate(x) for x in zip(*parts, strict=True))  # of: row and family
        if not len(of):
            return []
        low = max(1, int(place.max()).bit_length())
        large = np.zeros((int(of.max()) + 1, 1 << low), dtype=bool)
        large[of, place] = n > most
        code = np.repeat(of << (self.bits + low) | place, n) | self.cands[spread(starts, n)].astype(np.int64) << low
        code.sort()
        if self.repeated:
            code = code[_firsts(code)]
        at, cand = code >> (self.bits + low), code >> low & ((1 << self.bits) - 1)
        pos = code & ((1 << low) - 1)
        met = np.flatnonzero(_firsts(code >> low))
        many = np.diff(np.append(met, len(code)))
        met, many = met[many > 1], many[many > 1]
        whole, found = large.copy(), []
        square = np.cumsum(many * many)
        cut = 0
        while cut < len(met):  # a record's family is never cut in two
            stop = max(cut + 1, int(np.searchsorted(square, (square[cut - 1] if cut else 0) + ENTRIES, side="right")))
            stop = int(np.searchsorted(at[met], at[met[stop - 1]], side="right"))
            g, m = met[cut:stop], many[cut:stop]
            cut = stop
            one = spread(g, m)
            times = np.repeat(m, m)
            left, right = np.repeat(one, times), spread(np.repeat(g, m), times)
            keep = large[at[left], pos[left]]
            keep &= np.abs(pos[left] - pos[right]) >= np.where(at[left] % WHOLE == NGRAM, self.config.ngram_size, 1)
            left, right = left[keep], right[keep]
            both = at[left] << (2 * low) | pos[left] << low | pos[right]
            tried, count = np.unique(both, return_counts=True)
            tried = tried[count <= most]
            best = tried[_firsts(tried >> low)]  # the first partner
            if len(best):
                whole[best >> (2 * low), best >> low & ((1 << low) - 1)] = False
                hit = left[best[np.minimum(np.searchsorted(best, both), len(best) - 1)] == both]
                found.append(hit)
        for k, which in enumerate((large & ~whole, whole)):
            many = which.sum(axis=1)
            events[:, k] = np.bincount(np.arange(len(many)) // WHOLE, weights=many, minlength=len(events))
        kept = np.flatnonzero(~large[at, pos] | whole[at, pos])
        return [(at[i] // WHOLE) << (self.bits + 3) | cand[i] << 3 | OF_FAMILY[at[i] % WHOLE] for i in (kept, *found)]


def _only(rows: pa.RecordBatch, ids: pa.Array, *families: int) -> pa.RecordBatch:
    """rows with other ids and the keys of these families alone."""
    none = pa.ListArray.from_arrays(pa.array(np.zeros(len(ids) + 1, np.int32)), pa.array([], pa.int64()))
    keys = [rows.column(f"k{f}") if f in families else none for f in range(len(FAMILIES))]
    return pa.RecordBatch.from_arrays([ids, rows.column("country"), *keys], names=["id", "country", *(f"k{f}" for f in range(len(FAMILIES)))])


def _named(rows: pa.RecordBatch, country: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]:
    """The rows with a name and a known country, those of one name and country together; where each such group starts; the
    group of each row, or -1; and one row for each group, by number."""
    whole, row, _ = _lists(rows.column(f"k{WHOLE}"))
    known = country[row] >= KNOWN
    whole, row = whole[known], row[known]
    order = np.lexsort((country[row], whole))
    whole, row = whole[order], row[order]
    starts = np.append(np.flatnonzero(_firsts(whole) | _firsts(country[row])), len(row))
    of = np.full(rows.num_rows, -1)
    of[row] = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    groups = rows.select(["country", *(f"k{f}" for f in (NAME, WHOLE))]).take(pa.array(row[starts[:-1]]))
    return row, starts, of, groups


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """From and to of runs of at most ENTRIES together, or of one."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENTRIES, side="right")))
        yield at, stop
        at = stop


class Crossing:
    """The candidates of a source, each id once, for the pass of other countries alone. What names give is the same for all
    records of one name and country, on both sides: it is found once for each such group and then dealt out to its records.
    Only numbers and locations are asked by each record."""

    def __init__(self, batches: list[pa.RecordBatch], config: BlockingConfig):
        self.config = config
        self.rows = pa.concat_batches(batches)
        batches.clear()
        self.ids = self.rows.column("id")
        self.bits = max(1, len(self.ids).bit_length())
        self.places = Index([_only(self.rows, self.ids, PLACE)], config, ALONE)
        self.members, starts, self.of, groups = _named(self.rows, self.places.country(self.rows.column("country")))
        self.starts, self.sizes = starts[:-1], np.diff(starts)
        self.names = Index([_only(groups, pa.array(np.arange(groups.num_rows)), NAME, WHOLE)], config, ALONE)

    def answer(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """As Index.answer, but batch is one part, whose pairs come in any order."""
        if not _news(batch.column("id")).all():  # such a record has the names of all its rows
            yield from Index([self.rows], self.config, ALONE).answer(batch)
            return
        for row, cand in self._pairs(batch):
            yield 0, batch.num_rows, row, cand, np.full(len(row), 1 << CROSS, np.uint8), np.zeros((batch.num_rows, len(EVENTS)), np.int64)

    def _pairs(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        members, starts, of, groups = _named(batch, self.places.country(batch.column("country")))
        near = [(row + at, cand) for at, _, row, cand, *_ in self.places.answer(_only(batch, batch.column("id"), PLACE))]
        row, cand = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*near, strict=True) if near else ((), ())))
        pair = np.where((of[row] >= 0) & (self.of[cand] >= 0), of[row] << self.bits | self.of[cand], -1)
        order = np.argsort(pair, kind="stable")
        row, cand, pair = row[order], cand[order], pair[order]
        more = np.ones(len(pair), dtype=bool)  # what names don't give
        for at, n, group, other, *_ in self.names.answer(_only(groups, pa.array(np.arange(groups.num_rows)), NAME, WHOLE)):
            if not len(group):
                continue
            given = group + at << self.bits | other
            a, b = np.searchsorted(pair, [at << self.bits, at + n << self.bits])
            more[a:b] = given[np.minimum(np.searchsorted(given, pair[a:b]), len(given) - 1)] != pair[a:b]
            cuts = np.searchsorted(group, np.arange(n + 1))
            ends = np.append(0, np.cumsum(self.sizes[other]))[cuts]
            for first, last in _parts(np.diff(ends)):
                which = slice(cuts[first], cuts[last])
                size = self.sizes[other[which]]
                code = np.repeat(group[which] << self.bits, size) | self.members[spread(self.starts[other[which]], size)]
                code.sort()
                cands = code & ((1 << self.bits) - 1)
                asking = members[starts[at + first] : starts[at + last]]
                begin, size = ends[of[asking] - at] - ends[first], np.diff(ends)[of[asking] - at]
                for i, j in _parts(size):
                    yield np.repeat(asking[i:j], size[i:j]), cands[spread(begin[i:j], size[i:j])]
        yield row[more], cand[more]


def index_of(batches: list[pa.RecordBatch], config: BlockingConfig, passes: frozenset[str]) -> Index | Crossing:
    once = passes == ALONE and _news(pa.concat_arrays([b.column("id") for b in batches])).all()
    return Crossing(batches, config) if once else Index(batches, config, passes)


def cells(s1: DataFrame, candidates: DataFrame, sources: list[str], shares: int, wanted: DataFrame | None) -> DataFrame:
    """Rows of both sides, each cell in a partition of its own, candidates first and by id."""
    number = F.array_position(F.array(*map(F.lit, sources)), F.col("source")).cast("int") - 1
    keys = [f"k{i}" for i in range(len(FAMILIES))]
    none = F.expr("cast(null as array<string>)")
    share = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    right = candidates.select(F.lit(0).alias("side"), number.alias("of"), share.alias("share"), "id", "country", *keys, none.alias("wanted"))
    if wanted is not None:
        s1 = s1.join(wanted.groupBy(F.col("s1_id").alias("id")).agg(F.collect_set("cand_id").alias("wanted")), "id", "left")
    mine = F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int")
    left = s1.select(F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.lit(len(sources) - 1))).alias("of"), mine.alias("share"), "id", "country", *keys, (none if wanted is None else F.col("wanted")).alias("wanted"))
    both = right.unionByName(left).withColumn("cell", (F.col("of") * shares + F.col("share")).cast("int"))
    return both.repartitionById(len(sources) * shares, F.col("cell")).select(*[x.split()[0] for x in ROW.split(", ")]).sortWithinPartitions("cell", "side", "id")


def passes_of(config: BlockingConfig) -> frozenset[str]:
    off = {"missing": config.allow_missing_country_fallback, "cross": config.allow_cross_country_high_specificity}
    return frozenset(p for p in ("exact", "blocks", "missing", "cross") if off.get(p, True))


def _answers(batches: Iterator[pa.RecordBatch], config: BlockingConfig, passes: frozenset[str]) -> Iterator[tuple]:
    """Cell, asking batch, index and what it answers: rows, candidates, masks and events."""
    cell, before, index, held = None, [], None, None

    def told(part: pa.RecordBatch) -> Iterator[tuple]:
        if index is not None:
            for at, n, *told_of in index.answer(part):
                yield int(cell), part.slice(at, n), index, *told_of

    for batch in batches:
        cell_of, side = np.asarray(batch.column("cell")), np.asarray(batch.column("side"))
        cuts = np.append(np.flatnonzero(_firsts(cell_of * 2 + side)), batch.num_rows)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if cell_of[a] != cell:
                if held is not None:
                    yield from told(held)
                cell, before, index, held = cell_of[a], [], None, None
            part = batch.slice(a, b - a)
            if side[a] == 0:
                before.append(part)
                continue
            if before:
                index = index_of(before, config, passes)
            if held is not None:
                part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            last = int(np.flatnonzero(_news(part.column("id")))[-1])  # more rows of this id may come
            held = part.slice(last)
            if last:
                yield from told(part.slice(0, last))
    if held is not None:
        yield from told(held)


def pairs(rows: DataFrame, sources: list[str], shares: int, config: BlockingConfig, passes: frozenset[str], told: tuple[str, ...] = ("s1_id", "source", "cand_id", "provenance")) -> DataFrame:
    """One row for each pair, with the columns told, as each costs time for every pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, part, index, row, cand, mask, _ in _answers(batches, config, passes):
            for a in range(0, len(row), 1 << 17):
                i, j = row[a : a + (1 << 17)], cand[a : a + (1 << 17)]
                make = {
                    "s1_id": lambda i=i, part=part: part.column("id").take(pa.array(i)), "cand_id": lambda j=j, index=index: index.ids.take(pa.array(j)),
                    "source": lambda i=i, cell=cell: pa.array([sources[cell // shares]]).take(pa.array(np.zeros(len(i), np.int32))),
                    "provenance": lambda a=a, mask=mask: pa.array(mask[a : a + (1 << 17)].astype(np.int32)),
                }
                yield pa.RecordBatch.from_arrays([make[c]() for c in told], names=list(told))

    return rows.mapInArrow(released(run), ", ".join(x for x in PAIR.split(", ") if x.split()[0] in told))


def listed(rows: DataFrame, sources: list[str], shares: int, config: BlockingConfig) -> DataFrame:
    """The pairs of all passes as lists.LIST, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, forms = None, ()
        for cell, part, index, row, cand, mask, _ in _answers(batches, config, passes_of(config)):
            if not len(row):
                continue
            if of != cell:
                of, forms = cell, lists.split_all(index.ids)
            prefix, width, form, number = forms
            form, number = form[cand], number[cand]
            if len(prefix) > 1:
                order = np.lexsort((number, form, row))
                row, form, number, mask = row[order], form[order], number[order], mask[order]
            starts = np.flatnonzero(_firsts(row * len(prefix) + form))
            n = np.diff(np.append(starts, len(row)))
            one = form[starts]
            columns = [part.column("id").take(pa.array(row[starts])), pa.array([sources[cell // shares]] * len(n), pa.string()), prefix.take(pa.array(one)), pa.array(width[one]), pa.array(n)]
            yield pa.RecordBatch.from_arrays([*columns, *lists.pack(n, number, mask)], names=[x.split()[0] for x in lists.LIST.split(", ")])

    return rows.mapInArrow(released(run), lists.LIST)


def found_schema(events: bool) -> str:
    return ", ".join([FOUND, *(f"{e} long" for e in EVENTS if events)])


def found(rows: DataFrame, sources: list[str], shares: int, config: BlockingConfig, most: int, events: bool = False) -> DataFrame:
    """For each record and source with pairs: how many, by mask, and with ranks the first ``most`` and those that are wanted.
    With events also the EVENTS, and rows with these alone."""
    score = scores()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, part, index, row, cand, mask, met in _answers(batches, config, passes_of(config)):
            if not len(row) and not (events and met.any()):
                continue
            n = part.num_rows
            generated = np.bincount(row, minlength=n)
            by_mask = np.bincount(row << 7 | mask, minlength=n << 7).reshape(n, 128)
            mrow, mvalue = np.nonzero(by_mask)
            low = index.bits
            order = row << (low + 10) | (1023 - score[mask]) << low | cand  # scores have 10 bits
            order.sort()
            at = order >> (low + 10)
            rank = np.arange(len(order)) - (np.cumsum(generated) - generated)[at] + 1
            cands = order & ((1 << low) - 1)
            keep = rank <= most
            values, wrow, _ = _lists(part.column("wanted"))
            if len(values):
                known = pc.index_in(pa.array(values, pa.string()), index.ids).fill_null(-1).to_numpy(zero_copy_only=False)
                keep |= np.isin(at << low | cands, (wrow << low | known)[known >= 0])
            at, cands, rank = at[keep], cands[keep], rank[keep]
            mask_of = mask[np.searchsorted(row << low | cand, at << low | cands)]
            has = np.flatnonzero(generated + met.sum(axis=1) if events else generated)
            offsets = lambda of: pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=n)[has])).astype(np.int32))
            masks = pa.ListArray.from_arrays(offsets(mrow), pa.StructArray.from_arrays([pa.array(mvalue.astype(np.int32)), pa.array(by_mask[mrow, mvalue])], ["provenance", "n"]))
            kept = pa.ListArray.from_arrays(offsets(at), pa.StructArray.from_arrays([index.ids.take(pa.array(cands)), pa.array(mask_of.astype(np.int32)), pa.array(rank.astype(np.int32))], ["cand_id", "provenance", "rank"]))
            columns = [part.column("id").take(pa.array(has)), pa.array([sources[cell // shares]] * len(has), pa.string()), pa.array(generated[has]), masks, kept]
            more = [pa.array(met[has, k]) for k in range(len(EVENTS))] if events else []
            yield pa.RecordBatch.from_arrays([*columns, *more], names=["s1_id", "source", "generated", "masks", "kept", *EVENTS[: len(more)]])

    return rows.mapInArrow(released(run), found_schema(events))
