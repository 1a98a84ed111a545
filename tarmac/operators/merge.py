"""Adding flights to a fact without adding one twice.

Only the months that a batch touches are looked at, and of their flights only those whose keys may be among the
batch's: a Bloom filter of the batch's keys, a table of bitmaps small enough to be broadcast, goes over the
stored keys first. What is left, mostly true matches, meets the batch in an anti join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.session import cut_lineage

#: Bits in one bitmap of Spark's bitmap functions.
BITMAP = 32_768


def touched_months(batch: DataFrame) -> list[tuple[int, int]]:
    """The (year, month) pairs of a batch; there are twelve a year."""
    return sorted(map(tuple, batch.select("year", "month").distinct().collect()))


def in_months(months: list[tuple[int, int]], year: str = "year", month: str = "month") -> Column:
    """A filter on the partition columns, so that other months are not read."""
    years: dict[int, list[int]] = {}
    for y, m in months:
        years.setdefault(y, []).append(m)
    parts = [(F.col(year) == y) & F.col(month).isin(*m) for y, m in years.items()]
    return reduce(Column.__or__, parts, F.lit(False))


def _place(key: Column, bitmaps: int) -> Column:
    """The bit of a key, counted from 1."""
    return F.pmod(F.xxhash64(key), F.lit(bitmaps * BITMAP)) + 1


def key_filter(keys: DataFrame, key: str, bitmaps: int) -> DataFrame:
    """(bucket, bits): one bit for every key, in ``bitmaps`` bitmaps."""
    place = _place(F.col(key), bitmaps)
    return keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def bitmaps_for(count: int, bits_per_key: int = 8) -> int:
    """How many bitmaps of 4 KB a filter of ``count`` keys takes."""
    return max(1, math.ceil(count * bits_per_key / BITMAP))


def marked(rows: DataFrame, key: str, keys: DataFrame, bitmaps: int, name: str) -> DataFrame:
    """The rows with a column ``name``: whether their key has its bit set in ``keys`` (see ``key_filter``).

    True for every key of the filter, and with 8 bits a key for one in nine others. The filter is broadcast: the
    caller bounds ``bitmaps``.
    """
    place = _place(F.col(key), bitmaps)
    columns = [f"{name}_{part}" for part in ("bucket", "bit", "bits")]
    bucket, bit, bits = columns
    held = keys.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits))
    dealt = rows.withColumns({bucket: F.bitmap_bucket_number(place), bit: F.bitmap_bit_position(place)})
    met = dealt.join(F.broadcast(held), bucket, "left")
    byte = F.conv(F.hex(F.substr(bits, (F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    is_set = F.getbit(byte, (F.col(bit) % 8).cast("int")) == 1
    return met.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def may_contain(rows: DataFrame, key: str, keys: DataFrame, bitmaps: int) -> DataFrame:
    """The rows whose key may be in a filter (see ``marked``)."""
    return marked(rows, key, keys, bitmaps, "_marked").filter("_marked").drop("_marked")


def not_loaded(
    batch: DataFrame, loaded: DataFrame, key: str = "flight_key", bits_per_key: int = 8, most_bitmaps: int = 4096,
    keys: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``batch`` whose key no row of ``loaded`` has in the same months.

    Both have the partition columns year and month. Rows of the batch that share a key all stay. Above
    ``most_bitmaps`` bitmaps of 4 KB the filter would be too large to broadcast; then the keys of the touched
    months meet the batch's directly. The batch's rows are only joined if some of them are loaded already.
    ``keys`` are the batch's keys, year and month, if they are written already.
    """
    spark = batch.sparkSession
    if keys is None:
        keys = cut_lineage(spark, batch.select(key, "year", "month"), "keys")
    sizes = {(r["year"], r["month"]): r["count"] for r in keys.groupBy("year", "month").count().collect()}  # twelve a year
    held = loaded.filter(in_months(sorted(sizes))).select(key)
    bitmaps = bitmaps_for(sum(sizes.values()), bits_per_key)
    if bitmaps <= most_bitmaps:
        bits = cut_lineage(spark, key_filter(keys, key, bitmaps), "bits")
        held = may_contain(held, key, bits, bitmaps)
    again = cut_lineage(spark, held.join(keys.select(key), key, "left_semi"), "again")
    return batch if again.isEmpty() else batch.join(again, key, "left_anti")
