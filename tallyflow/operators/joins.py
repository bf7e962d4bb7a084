"""Joins: dictionary and dimension look-ups, and time-bounded joins.

Nothing here hints a broadcast.  Look-up sides below the size limits in
`session.JOB_CONF` are broadcast by Spark; larger ones are shuffled, and AQE
splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import seconds, watermarked


def hot_key_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join to a side with one row per key, where one key may own much of `left`.

    A right side that comes out of a per-key aggregate or window is already
    partitioned by the keys.  Spark would join it as it lies, and AQE only splits
    an overfull partition between two shuffles made for the join.  One more key,
    derived from the others, asks for that shuffle; it changes no match.
    """
    tag = F.xxhash64(*keys)
    return left.withColumn("_tag", tag).join(right.withColumn("_tag", tag), [*keys, "_tag"], how).drop("_tag")


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, take: dict[str, str], how: str = "inner") -> DataFrame:
    """Add `{source column: new column}` of `table` where its key equals `key`.

    `inner` drops rows without a match, as the feeds' lookup joins do; `left`
    keeps them with NULLs.
    """
    side = table.select(F.col(table_key).alias(key), *[F.col(c).alias(n) for c, n in take.items()])
    return hot_key_join(df, side, [key], how).select(*df.columns, *take.values())


def with_dictionary(df: DataFrame, dictionary: DataFrame, code: str, name: str, how: str = "inner") -> DataFrame:
    return lookup(df, dictionary, code, "dic_code", {"dic_name": name}, how)


def within(left_ts: Column, right_ts: Column, before: str, after: str) -> Column:
    """right in [left - before, left + after], both ends closed."""
    return right_ts.between(left_ts - F.expr(f"interval {before}"), left_ts + F.expr(f"interval {after}"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    right_ts: str,
    before: str = "5 seconds",
    after: str = "5 seconds",
) -> DataFrame:
    """Inner join on `key` and a closed time interval, for tables.

    Both sides are cut into time blocks of the interval's length and joined on
    (key, block), so a busy key is spread over time and only rows of touching
    blocks are compared.  Column names other than `key` must differ.
    """
    size = max(1, seconds(before) + seconds(after))

    def slot(ts_col: Column) -> Column:
        return F.floor(F.unix_seconds(ts_col) / size)

    r_ts = F.col(right_ts)
    reach = F.sequence(
        slot(r_ts - F.expr(f"interval {after}")), slot(r_ts + F.expr(f"interval {before}"))
    )
    rows = left.withColumn("_slot", slot(F.col(ts)))
    others = right.withColumn("_slot", F.explode(reach))
    return (
        rows.join(others, [key, "_slot"])
        .where(within(F.col(ts), r_ts, before, after))
        .drop("_slot")
    )


def stream_join(
    left: DataFrame,
    right: DataFrame,
    on: Column,
    ts: str,
    right_ts: str,
    before: str,
    after: str,
    how: str = "inner",
    delay: str = "2 seconds",
) -> DataFrame:
    """The same join for two streams; the time bound also bounds the join state."""
    l_side = watermarked(left, ts, delay)
    r_side = watermarked(right, right_ts, delay)
    return l_side.join(r_side, on & within(F.col(ts), F.col(right_ts), before, after), how)
