"""A blocked Bloom filter of 64-bit keys, built and asked by DataFrame functions only.

A key has ``PROBES`` bits in one block of 4 KB. There is a block for each ``PER_BLOCK`` keys, so the filter grows with
its keys and about one other key in a hundred passes at any size. A filter of up to ``MOST_BROADCAST`` bytes goes to
all tasks; beyond that, rows meet their block in a shuffled join (which splits blocks that many rows ask for).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

BLOCK_BITS, PROBES, PER_BLOCK = 32768, 3, 3000
MOST_BROADCAST = 16 << 20


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(BLOCK_BITS)).cast("int") for i in range(PROBES)]


class BloomFilter:
    def __init__(self, keys: DataFrame):
        """keys: one column, ``key``; repeated ones do no harm. It is read twice: stage it before."""
        self.blocks = keys.count() // PER_BLOCK + 1
        bits = keys.select(_block(F.col("key"), self.blocks).alias("block"), F.explode(F.array(*_bits(F.col("key")))).alias("bit"))
        filters = stage(bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("filter")), "bloom-filter")
        self.filters = F.broadcast(filters) if self.blocks * BLOCK_BITS // 8 <= MOST_BROADCAST else filters

    def mark(self, rows: DataFrame, key: Column) -> DataFrame:
        """rows with ``maybe``: true for every row whose key is in the filter, and for a few others. rows must not have
        columns named block or filter."""
        bits = _bits(key)
        tested = rows.withColumn("block", _block(key, self.blocks)).join(self.filters, "block", "left")
        held = [F.getbit(F.conv(F.hex(F.substring("filter", F.floor(b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint"), b % 8) == 1 for b in bits]
        return tested.withColumn("maybe", F.coalesce(reduce(Column.__and__, held), F.lit(False))).drop("block", "filter")
