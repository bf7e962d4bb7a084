"""Event-time tumbling window aggregates, the same for tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import stamp_text, watermarked

WINDOW = "10 seconds"
DELAY = "2 seconds"


def money(amount: Column | str) -> Column:
    """Amounts travel as text; they are summed as exact decimals."""
    return (F.col(amount) if isinstance(amount, str) else amount).try_cast("decimal(18,2)")


def amount(col: Column | str) -> Column:
    """Edge form of a summed amount."""
    return F.round((F.col(col) if isinstance(col, str) else col).cast("double"), 2)


def _with_bounds(df: DataFrame) -> list[Column]:
    return [stamp_text(F.col("window.start")).alias("stt"), stamp_text(F.col("window.end")).alias("edt")]


def window_sums(
    df: DataFrame,
    ts: str,
    sums: dict[str, Column],
    keys: tuple[str, ...] = (),
    length: str = WINDOW,
    delay: str = DELAY,
) -> DataFrame:
    """Sums per window and keys, with window bounds as text.

    Without keys the window itself is the group; partial sums are made in every
    input task, so one window does not mean one busy task.
    """
    grouped = watermarked(df, ts, delay).groupBy(F.window(ts, length), *keys)
    totals = grouped.agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return totals.select(*_with_bounds(totals), *keys, *sums)


def window_distinct(
    df: DataFrame,
    ts: str,
    keys: tuple[str, ...],
    item: str,
    count_as: str,
    sums: dict[str, Column] | None = None,
    length: str = WINDOW,
    delay: str = DELAY,
) -> DataFrame:
    """Exact number of distinct `item` per window and keys, and sums.

    Two aggregates in a row: first per item, then per key.  No set of items is
    ever gathered, and streams may run it too.
    """
    sums = sums or {}
    per_item = watermarked(df, ts, delay).groupBy(F.window(ts, length), *keys, item)
    per_item = per_item.agg(*[F.sum(c).alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias("_n"))
    if df.isStreaming:
        again = F.window(F.window_time("window"), length)
    else:
        again = F.col("window")
    totals = per_item.groupBy(again.alias("window"), *keys).agg(
        F.count(item).alias(count_as), *[F.sum(n).alias(n) for n in sums]
    )
    return totals.select(*_with_bounds(totals), *keys, count_as, *sums)


def stamped(metric: DataFrame) -> DataFrame:
    """Sink form: adds the processing time `ts` in milliseconds as last column."""
    return metric.withColumn("ts", F.unix_millis(F.current_timestamp()))
