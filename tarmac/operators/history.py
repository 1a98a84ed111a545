"""Trailing aggregates over ordered peer groups, without ever putting a whole hot group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import cut_lineage, task_memory

# Slices are cut by the first four hex digits of the hash key, which is part of the row order.
_SLICE_UNITS = 16**4
#: A group stands in a task's memory in the sort and in both windows behind it, and grows there as it is copied.
_SHARE = 8


def rows_in_memory(df: DataFrame) -> int:
    """How many rows of ``df`` a window's group may have, by the memory of a task.

    A window holds the whole group it is in. What it can't hold it writes to disk, but its readers take memory outside
    the share of the tasks, for each file and until the task ends.
    """
    texts = sum(kind in ("string", "binary") for _, kind in df.dtypes)
    width = 32 + 8 * len(df.columns) + 32 * texts  # the row with its head and its place in the order
    return max(1, int(task_memory(df.sparkSession) / _SHARE / width))


def hot_groups(base: DataFrame, keys: Sequence[str], day: str, split_rows: int) -> DataFrame:
    """Peer groups with more than ``split_rows`` rows, and the number of slices their days need.

    There are at most ``rows / split_rows`` such groups. The list is joined without a hint: adaptive execution
    measures it and broadcasts it only below the threshold.
    """
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    large = sizes.filter(F.col("_total") > split_rows).select(*keys)
    # Days are counted in the large groups only; usually there are none.
    per_day = (
        base.join(large, list(keys), "left_semi")
        .groupBy(*keys, day)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    slices = F.least(F.ceil(F.max("_n") / split_rows), F.lit(_SLICE_UNITS)).cast("int")
    return per_day.groupBy(*keys).agg(slices.alias("_slices"))


def _slice(digits: Column) -> Column:
    leading = F.conv(F.substring(digits, 1, 4), 16, 10).cast("int")
    return F.floor(leading * F.col("_slices") / _SLICE_UNITS).cast("int")


def _chunked(df: DataFrame, hot: DataFrame, keys: Sequence[str], day: str, tie_key: str, how: str) -> DataFrame:
    """Add the chunk of each row: (day, slice) in hot groups, one chunk for a whole cold group."""
    split = F.col("_slices").isNotNull()
    digits = F.hex(tie_key) if dict(df.dtypes)[tie_key] == "binary" else F.col(tie_key)
    return (
        df.join(hot, list(keys), how)
        .withColumns(
            {
                "_day": F.when(split, F.col(day)).otherwise(0),
                "_slice": F.when(split, _slice(digits)).otherwise(0),
            }
        )
        .drop("_slices")
    )


def needs_split(base: DataFrame, peers: Sequence[Sequence[str]], split_rows: int) -> list[bool]:
    """For each list of keys, whether any of its groups has more than ``split_rows`` rows; one pass over ``base``."""
    columns = list(dict.fromkeys(k for keys in peers for k in keys))
    level = F.grouping_id().alias("_level")
    sizes = base.groupingSets([list(k) for k in peers], *columns).agg(F.count(F.lit(1)).alias("_n"), level)
    found = sizes.filter(F.col("_n") > split_rows).select("_level").distinct().collect()  # one row a list at most
    hot = {r["_level"] for r in found}
    # The grouping id has a bit for every column that is not among the keys, the first column highest.
    bits = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    return [sum(bits[c] for c in columns if c not in keys) in hot for keys in peers]


def trailing_average(
    df: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    day: str,
    tie_key: str,
    value: str,
    name: str,
    rows: int,
    split_rows: int,
    split: bool = True,
) -> DataFrame:
    """Add ``name``: the mean ``value`` of the ``rows`` rows before each row of its peer group.

    The order inside a group is ``day``, then ``tie_key``, a hash of the row identity in hexadecimal or bytes, then
    ``value``, an integer column whose null values do not count.
    ``base`` holds the same rows as ``df`` before other windows were added, so that finding hot groups
    and their chunk tails does not repeat those windows.

    A group above ``split_rows`` is cut into chunks along that order, by day and by leading hash
    digits. Each chunk receives the last ``rows`` rows that precede it as a prefix, so its window gives
    the same answer as one window over the whole group. Without ``split``, for when ``needs_split`` has found no
    such group, there is only that window.
    """
    keys = list(keys)
    if not split:
        ordered = Window.partitionBy(*keys).orderBy(day, tie_key, value)
        return _trailing(df, ordered, value, name, rows).drop("_sum", "_count")
    narrow = base.select(*dict.fromkeys([*keys, day, tie_key, value]))
    # Written, so that its size is known and the rows need not move to meet it.
    hot = cut_lineage(df.sparkSession, hot_groups(narrow, keys, day, split_rows), "hot-groups")
    chunk = [*keys, "_day", "_slice"]
    ordered = Window.partitionBy(*chunk).orderBy(day, tie_key, value)

    # The last rows of every chunk; the row_number limit keeps at most `rows` per chunk and map task.
    backwards = Window.partitionBy(*chunk).orderBy(F.desc(day), F.desc(tie_key), F.desc(value))
    tails = (
        _chunked(narrow, hot, keys, day, tie_key, "inner")
        .withColumn("_back", F.row_number().over(backwards))
        .filter(F.col("_back") <= rows)
        .groupBy(*chunk)
        .agg(F.sort_array(F.collect_list(F.struct(day, tie_key, value))).alias("_tail"))
    )
    # No chunk is empty, so the previous `rows` chunks hold at least `rows` rows if the group has them.
    before = Window.partitionBy(*keys).orderBy("_day", "_slice").rowsBetween(-rows, -1)
    preceding = F.flatten(F.collect_list("_tail").over(before))
    last_rows = F.when(F.size(preceding) > rows, F.slice(preceding, -rows, rows)).otherwise(preceding)
    prefix = (
        tails.select(*chunk, last_rows.alias("_rows"))
        .select(*chunk, F.explode("_rows").alias("_row"))
        .select(*chunk, "_row.*")
        .withColumn("_prefix", F.lit(True))
    )
    body = _chunked(df, hot, keys, day, tie_key, "left").withColumn("_prefix", F.lit(False))
    both = body.unionByName(prefix, allowMissingColumns=True)
    return (
        _trailing(both, ordered, value, name, rows)
        .filter(~F.col("_prefix"))
        .drop("_day", "_slice", "_prefix", "_sum", "_count")
    )


def _trailing(df: DataFrame, ordered, value: str, name: str, rows: int) -> DataFrame:
    # Differences of running totals cost the same for every row, whatever the number of rows; a
    # sliding frame would add up all of them again for each row.
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = df.withColumns(
        {"_sum": F.sum(F.coalesce(value, F.lit(0))).over(upto), "_count": F.count(value).over(upto)}
    )

    def trailing(total: str) -> Column:
        return F.lag(total, 1, 0).over(ordered) - F.lag(total, rows + 1, 0).over(ordered)

    n = F.nullif(trailing("_count"), F.lit(0).cast("bigint"))
    return running.withColumn(name, trailing("_sum") / n)
