"""Semi and anti joins that shuffle only the rows a Bloom filter lets through."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HASHED = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampType(), T.StringType(), T.BinaryType()]
#: Bits of a block (a whole bitmap of Spark's bitmap aggregate), bits a key, probes a key.
BLOCK_BITS, KEY_BITS, PROBES = 32_768, 16, 4
#: The filter is handed to all tasks, so it may take this many bytes and no more.
FILTER_BYTES = 64 << 20


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _places(key: Column) -> list[Column]:
    """Places of a key's bits in its block: 15 bits of a second hash each."""
    other = F.xxhash64(F.lit(1), key)
    return [F.shiftrightunsigned(other, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(PROBES)]


def blocks_for(n_keys: int) -> int:
    return max(1, -(-n_keys * KEY_BITS // BLOCK_BITS))


def key_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """(_block, _bits): a blocked Bloom filter of a column, built by an aggregate; NULLs are left out.

    Bits are combined in each map task, so what is shuffled is bounded by the filter's size.
    """
    key = F.col(column)
    bits = keys.filter(key.isNotNull()).select(_block(key, blocks).alias("_block"), F.explode(F.array(*_places(key))).alias("_place"))
    return bits.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def flagged(rows: DataFrame, column: str, found: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``_possible``: false where the key is certainly not in the filter (or NULL)."""
    key = F.col(column)

    def bit(place: Column) -> Column:
        at = F.decode(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1")
        return F.getbit(F.ascii(at), F.pmod(place, F.lit(8)).cast("int")) == 1

    named = rows.withColumn("_wanted", _block(key, blocks))
    near = named.join(F.broadcast(found), F.col("_wanted") == F.col("_block"), "left")
    possible = key.isNotNull() & F.col("_bits").isNotNull() & reduce(and_, [bit(p) for p in _places(key)])
    return near.withColumn("_possible", possible).drop("_wanted", "_block", "_bits")


def member_join(rows: DataFrame, keys: DataFrame, on: tuple[str, str], how: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of ``rows`` with ``keys``, equal to Spark's own, NULLs included.

    The filter takes two bytes a key.  If the keys, counted first without repeats by a sketch
    of fixed size (2 % error), need more than ``filter_bytes``, the exact join runs alone.
    Otherwise rows outside the filter are settled where they lie, and only the rest meets the
    keys in an exact merge join, where Spark splits a hot key on the side of the rows.  Keys
    of two types, or of a type whose equal values may differ in bytes, take the exact join.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"no semi or anti join: {how}")
    left, right = on
    exact = keys.select(F.col(right).alias("_member")).filter("_member IS NOT NULL").distinct().hint("merge")
    same = F.col(left) == F.col("_member")
    kinds = rows.schema[left].dataType, keys.schema[right].dataType
    if kinds[0] != kinds[1] or kinds[0] not in _HASHED:
        return rows.join(exact, same, how)
    n_keys = keys.agg(F.approx_count_distinct(right, 0.02)).first()[0]
    blocks = blocks_for(n_keys)
    if blocks * (BLOCK_BITS // 8) > filter_bytes:
        return rows.join(exact, same, how)
    probed = flagged(rows, left, key_filter(keys, right, blocks), blocks)
    met = probed.filter("_possible").drop("_possible").join(exact, same, how)
    return met if how == "left_semi" else met.unionAll(probed.filter(~F.col("_possible")).drop("_possible"))
