"""Keyed rules over history: first and last row, daily uniques, repair, bounce.

These are the batch forms; `streaming.keyed` holds the stream forms.  A key may
own a large share of all rows, so no rule sorts one key's whole history:

* "first / last row of a group" is `row_number() = 1`, which Spark cuts down to
  one row per group in every input task before it shuffles;
* "first row of a day" then leaves at most one row per key and day, and only
  these few are ordered across days;
* "next / previous row within a gap" is looked up inside time blocks of a key,
  rows near a block's edge being lent to the neighbouring block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import hot_key_join


def _cols(names) -> list[Column]:
    names = [names] if isinstance(names, (str, Column)) else names
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _one_per(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    spec = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).where("_rn = 1").drop("_rn")


def first_per(df: DataFrame, keys, order) -> DataFrame:
    """First row of each group; `order` must be total for a fixed result."""
    return _one_per(df, keys, [c.asc() for c in _cols(order)])


def last_per(df: DataFrame, keys, order) -> DataFrame:
    """Last row of each group; among equal times the later arrival wins."""
    return _one_per(df, keys, [c.desc() for c in _cols(order)])


def day_firsts(df: DataFrame, keys, day, order) -> DataFrame:
    """Rows that open a new day for their key (daily unique rule)."""
    return first_per(df, [*_cols(keys), *_cols(day)], order)


def day_changes(df: DataFrame, key: str, day: str, order) -> DataFrame:
    """`day_firsts` with `is_first` (first day ever) and `days_away` since the last day."""
    past = F.lag(F.col(day)).over(Window.partitionBy(key).orderBy(day))
    return (
        day_firsts(df, key, day, order)
        .withColumn("_past", past)
        .withColumn("is_first", F.col("_past").isNull())
        .withColumn("days_away", F.datediff(F.col(day).cast("date"), F.col("_past").cast("date")))
        .drop("_past")
    )


def user_flags(df: DataFrame, key: str, day: str, ts: str, order, block: str = "5 minutes") -> DataFrame:
    """Every row with `unique_user` and `new_user` (1 on the first row of a day / ever).

    Rows that do not open their (key, time block) can carry neither flag; only
    the openers, few per key and day, are compared across blocks.
    """
    order = _cols(order)
    spec = Window.partitionBy(key, day, F.window(ts, block)["start"]).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(spec))
    openers = ranked.where("_rn = 1")
    past = F.lag(day).over(Window.partitionBy(key).orderBy(*order))
    flagged = (
        openers.withColumn("_past", past)
        .withColumn("unique_user", F.when(F.col("_past").eqNullSafe(F.col(day)), 0).otherwise(1).cast("bigint"))
        .withColumn("new_user", F.when(F.col("_past").isNull(), 1).otherwise(0).cast("bigint"))
        .drop("_rn", "_past")
    )
    rest = (
        ranked.where("_rn > 1")
        .drop("_rn")
        .withColumn("unique_user", F.lit(0).cast("bigint"))
        .withColumn("new_user", F.lit(0).cast("bigint"))
    )
    return flagged.unionByName(rest)


def repair_new_flag(logs: DataFrame, order=("ts",)) -> DataFrame:
    """New-visitor flag repair per `common.mid`.

    A visitor's first row fixes the first-visit day: its own day when it says
    new, the day before when it does not.  A later row that says new on another
    day is set to old.  The first day is one narrow row per visitor, found with
    partial sums, and joined back so that a busy visitor can be split.
    """
    mid, flag = F.col("common.mid"), F.col("common.is_new")
    day = F.to_date(F.timestamp_millis("ts"))
    opened = F.when(flag == "1", day).otherwise(F.date_sub(day, 1))
    order_key = _cols(order)[0] if len(order) == 1 else F.struct(*_cols(order))
    firsts = (
        logs.select(mid.alias("_mid"), opened.alias("_opened"), order_key.alias("_order"))
        .groupBy("_mid")
        .agg(F.min_by("_opened", "_order").alias("_opened"))
    )
    fixed = F.when((flag == "1") & (day != F.col("_opened")), "0").otherwise(flag)
    return (
        hot_key_join(logs.withColumn("_mid", mid), firsts, ["_mid"], "left")
        .withColumn("common", F.col("common").withField("is_new", fixed))
        .select(*logs.columns)
    )


def _in_blocks(df: DataFrame, ms: Column, gap: int, ahead: bool) -> DataFrame:
    """Rows with `_block`; rows within `gap` ms of an edge also appear, with
    `_lent`, in the block next to it (the earlier one for `ahead`)."""
    size = gap * 60
    block = F.floor(ms / size)
    inside = ms - block * size
    near = inside < gap if ahead else inside >= size - gap
    other = block - 1 if ahead else block + 1
    both = F.array(
        F.struct(block.alias("b"), F.lit(False).alias("lent")),
        F.struct(other.alias("b"), F.lit(True).alias("lent")),
    )
    own = F.array(F.struct(block.alias("b"), F.lit(False).alias("lent")))
    return (
        df.withColumn("_p", F.explode(F.when(near, both).otherwise(own)))
        .withColumn("_block", F.col("_p.b"))
        .withColumn("_lent", F.col("_p.lent"))
        .drop("_p")
    )


def mark_bounces(pages: DataFrame, key, entry: Column, ms: str, order, gap_ms: int = 10_000) -> DataFrame:
    """Adds `bounced`: an entry page followed, within the gap, by another entry
    page or by nothing.  A follower exactly `gap_ms` later is too late."""
    keys, order = _cols(key), _cols(order)
    marked = _in_blocks(pages.withColumn("_entry", entry), F.col(ms), gap_ms, ahead=True)
    spec = Window.partitionBy(*keys, "_block").orderBy(*order)
    follower = F.lead(F.struct(F.col(ms).alias("ms"), F.col("_entry").alias("entry"))).over(spec)
    alone = F.col("_next").isNull() | (F.col("_next.ms") - F.col(ms) >= gap_ms) | F.col("_next.entry")
    return (
        marked.withColumn("_next", follower)
        .where(~F.col("_lent"))
        .withColumn("bounced", F.col("_entry") & alone)
        .drop("_entry", "_next", "_block", "_lent")
    )


def bounces(pages: DataFrame, key, entry: Column, ms: str, order, gap_ms: int = 10_000) -> DataFrame:
    """The bounced entry pages."""
    return mark_bounces(pages, key, entry, ms, order, gap_ms).where("bounced").drop("bounced")


def first_wins_within(df: DataFrame, key, ms: str, order, ttl_ms: int = 5_000) -> DataFrame:
    """De-dup whose memory of a key fades `ttl_ms` after the key was last seen."""
    keys, order = _cols(key), _cols(order)
    marked = _in_blocks(df, F.col(ms), ttl_ms, ahead=False)
    spec = Window.partitionBy(*keys, "_block").orderBy(*order)
    past = F.lag(ms).over(spec)
    return (
        marked.withColumn("_past", past)
        .where(~F.col("_lent") & (F.col("_past").isNull() | (F.col(ms) - F.col("_past") >= ttl_ms)))
        .drop("_past", "_block", "_lent")
    )
