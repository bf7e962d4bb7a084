"""The eleven window metric jobs.

Each takes fact or log rows (tables or streams) and returns rows in the column
order of `schemas.METRICS`.  `length` is the window, `delay` the lateness a
stream waits for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import predicates as P
from ..functions.timefmt import at, day_text, leading_day, parse_stamp
from ..functions.tokens import split_words
from ..operators import dims as D
from ..operators import keyed as K
from ..operators.windows import WINDOW, amount, money, window_distinct, window_sums
from ..streaming import keyed as S


def _openers(df: DataFrame, key: str, day: str, ts: str, order: list) -> DataFrame:
    """First row per key and day, from history or from state."""
    if df.isStreaming:
        return S.day_openers(df, key, day, ts)
    return K.day_changes(df, key, day, order)


def _day_firsts(df: DataFrame, key: str, day: str, ts: str, order: list) -> DataFrame:
    """First row per key and day; the stream's state goes with the day."""
    if df.isStreaming:
        return S.day_firsts(df, key, day, ts)
    return K.day_firsts(df, key, day, order)


def _flag(rule: Column) -> Column:
    return F.when(rule, 1).otherwise(0).cast("bigint")


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _first_wins(rows: DataFrame, ts: str, order: list) -> DataFrame:
    if rows.isStreaming:
        return S.first_wins(rows, "id", ts)
    return K.first_per(rows, "id", order)


def _last_wins(rows: DataFrame, key: str, order: list, deduplicated: bool) -> DataFrame:
    if deduplicated:
        return rows
    if rows.isStreaming:
        # It gives rows out behind the watermark, so windows need a query of their own.
        raise ValueError("run streaming.keyed.last_wins first, as its own query, and pass deduplicated=True")
    return K.last_per(rows, key, ["row_op_ts", *order])


# --- users and carts -------------------------------------------------------
def cart_add_uu(carts: DataFrame, length: str = WINDOW) -> DataFrame:
    """Users who put something into the cart for the first time in a day."""
    text = F.coalesce("operate_time", "create_time")
    rows = carts.select(
        "user_id", "id", leading_day(text).alias("day"), parse_stamp(text).alias("rt")
    )
    users = _day_firsts(rows, "user_id", "day", "rt", ["rt", "id"])
    return window_sums(users, "rt", {"cart_add_uu_ct": _one()}, length=length)


def login(pages: DataFrame, length: str = WINDOW, back_days: int = 8) -> DataFrame:
    """Active users of a day, and those back after `back_days` or more."""
    rows = pages.where(P.login_page()).select(
        F.col("common.uid").alias("uid"), "ts", at("ts").alias("rt"), day_text(at("ts")).alias("day")
    )
    users = _openers(rows, "uid", "day", "rt", ["ts"])
    back = _flag(F.coalesce(F.col("days_away") >= back_days, F.lit(False)))
    return window_sums(users, "rt", {"back_ct": back, "uu_ct": _one()}, length=length)


def register(users: DataFrame, length: str = WINDOW) -> DataFrame:
    rows = users.select(parse_stamp("create_time").alias("rt"))
    return window_sums(rows, "rt", {"register_ct": _one()}, length=length)


# --- trade -----------------------------------------------------------------
def _order_lines(details: DataFrame) -> DataFrame:
    rows = details.withColumn("rt", parse_stamp("create_time"))
    return _first_wins(rows, "rt", ["row_op_ts", "create_time", "sku_id", "sku_num", "order_price"])


def original_amount() -> Column:
    return F.col("sku_num").try_cast("int") * money("order_price")


def order(details: DataFrame, length: str = WINDOW) -> DataFrame:
    """Ordering users and order amounts."""
    zero = F.lit(0).cast("decimal(28,2)")
    lines = _order_lines(details).select(
        "user_id",
        "id",
        "rt",
        leading_day("create_time").alias("day"),
        F.coalesce(money("split_activity_amount"), zero).alias("activity"),
        F.coalesce(money("split_coupon_amount"), zero).alias("coupon"),
        original_amount().cast("decimal(28,2)").alias("original"),
    )
    rows = _order_marks_stream(lines) if details.isStreaming else _order_marks(lines, length)
    sums = {
        "order_unique_user_count": F.col("users"),
        "order_new_user_count": F.col("fresh"),
        "order_activity_reduce_amount": F.col("activity"),
        "order_coupon_reduce_amount": F.col("coupon"),
        "order_origin_total_amount": F.col("original"),
    }
    totals = window_sums(rows, "rt", sums, length=length)
    return totals.select(*[amount(c).alias(c) if c.endswith("amount") else c for c in totals.columns])


_AMOUNTS = ("activity", "coupon", "original")


def _order_marks(lines: DataFrame, length: str) -> DataFrame:
    """One row per user, day and window, in one pass over the lines.

    The first line of a user's day lies in the first window of that day, so the
    windows, which are few however busy the user, are compared and not the lines.
    """
    start = F.window("rt", length)["start"].alias("rt")
    per_window = lines.groupBy("user_id", "day", start).agg(*[F.sum(a).alias(a) for a in _AMOUNTS])
    past = F.lag("day").over(Window.partitionBy("user_id").orderBy("rt", "day"))
    return per_window.withColumn("_past", past).select(
        "rt",
        _flag(~F.col("_past").eqNullSafe(F.col("day"))).alias("users"),
        _flag(F.col("_past").isNull()).alias("fresh"),
        *_AMOUNTS,
    )


def _order_marks_stream(lines: DataFrame) -> DataFrame:
    """The stream form: amounts as they are, users through keyed state."""
    none, zero = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(28,2)")
    amounts = lines.select("rt", none.alias("users"), none.alias("fresh"), *_AMOUNTS)
    openers = _openers(lines.select("user_id", "id", "rt", "day"), "user_id", "day", "rt", ["rt", "id"])
    users = openers.select(
        "rt", _one().alias("users"), _flag(F.col("is_first")).alias("fresh"), *[zero.alias(a) for a in _AMOUNTS]
    )
    return amounts.unionByName(users)


def payment(
    paid: DataFrame, length: str = WINDOW, include_returning: bool = False, deduplicated: bool = False
) -> DataFrame:
    """Paying users.  A user counts only at the first payment ever, so both
    counts agree; `include_returning` counts once per day instead."""
    rows = paid.withColumn("rt", parse_stamp("callback_time"))
    lines = _last_wins(rows, "order_detail_id", ["callback_time", "sku_id", "sku_num"], deduplicated).select(
        "user_id", "order_detail_id", "rt", leading_day("callback_time").alias("day")
    )
    users = _openers(lines, "user_id", "day", "rt", ["rt", "order_detail_id"])
    if not include_returning:
        users = users.where("is_first")
    sums = {
        "payment_suc_unique_user_count": _one(),
        "payment_suc_new_user_count": _flag(F.col("is_first")),
    }
    return window_sums(users, "rt", sums, length=length)


def province_order(
    details: DataFrame,
    dims: dict[str, DataFrame],
    length: str = WINDOW,
    how: str = "inner",
    deduplicated: bool = False,
) -> DataFrame:
    """Orders per province; the name is joined after the aggregate."""
    rows = details.withColumn("rt", parse_stamp("create_time"))
    lines = _last_wins(rows, "id", ["create_time", "sku_id", "sku_num", "order_price"], deduplicated).select(
        "province_id", "order_id", "rt", money("split_total_amount").alias("paid")
    )
    totals = window_distinct(
        lines, "rt", ("province_id",), "order_id", "order_count", {"order_amount": F.col("paid")}, length
    )
    named = D.with_province(totals, dims, how).withColumn("order_amount", amount("order_amount"))
    return named.select(*schemas.METRICS["province_order"])


def refund(refunds: DataFrame, dims: dict[str, DataFrame], length: str = WINDOW, how: str = "inner") -> DataFrame:
    """Refunded orders per trademark, category and user."""
    rows = refunds.select("sku_id", "user_id", "order_id", parse_stamp("create_time").alias("rt"))
    keyed = D.with_sku(rows, dims, spu=False, how=how)
    totals = window_distinct(
        keyed, "rt", ("user_id", "trademark_id", "category3_id"), "order_id", "refund_count", None, length
    )
    named = D.with_categories(D.with_trademark(totals, dims, how), dims, how)
    return named.select(*schemas.METRICS["refund"])


def user_spu_order(details: DataFrame, dims: dict[str, DataFrame], length: str = WINDOW, how: str = "inner") -> DataFrame:
    """Orders per user, spu, trademark and category."""
    lines = _order_lines(details).select(
        "sku_id", "user_id", "order_id", "rt", money("split_total_amount").alias("paid")
    )
    keyed = D.with_sku(lines, dims, how=how)
    keys = ("user_id", "spu_id", "trademark_id", "category3_id")
    totals = window_distinct(keyed, "rt", keys, "order_id", "order_count", {"order_amount": F.col("paid")}, length)
    named = D.with_categories(D.with_trademark(D.with_spu(totals, dims, how), dims, how), dims, how)
    return named.withColumn("order_amount", amount("order_amount")).select(*schemas.METRICS["user_spu_order"])


# --- traffic ---------------------------------------------------------------
def page_view(pages: DataFrame, length: str = WINDOW) -> DataFrame:
    """Daily unique visitors of the home page and of goods pages."""
    rows = pages.where(P.home_or_detail()).select(
        F.concat_ws("|", "common.mid", "page.page_id").alias("visitor"),
        F.col("page.page_id").alias("page_id"),
        "ts",
        at("ts").alias("rt"),
        day_text(at("ts")).alias("day"),
    )
    visits = _day_firsts(rows, "visitor", "day", "rt", ["ts"])
    sums = {
        "home_uv_ct": _flag(F.col("page_id") == "home"),
        "good_detail_uv_ct": _flag(F.col("page_id") == "good_detail"),
    }
    return window_sums(visits, "rt", sums, length=length)


def keyword(pages: DataFrame, length: str = WINDOW, source: str = "search") -> DataFrame:
    """Words searched for."""
    rows = pages.where(P.keyword_search()).select(F.col("page.item").alias("item"), at("ts").alias("rt"))
    counted = window_sums(
        split_words(rows, "item", "keyword"), "rt", {"keyword_count": _one()}, ("keyword",), length
    )
    return counted.withColumn("source", F.lit(source)).select(*schemas.METRICS["keyword"])


def unique_visitors(pages: DataFrame) -> DataFrame:
    """Entry pages that open a visitor's day."""
    entries = pages.where(P.entry_page())
    day = day_text(at("ts"))
    if entries.isStreaming:
        timed = entries.select("*", F.col("common.mid").alias("visitor"), day.alias("day"), at("ts").alias("rt"))
        return S.day_firsts(timed, "visitor", "day", "rt").select(*pages.columns)
    return K.day_firsts(entries, "common.mid", day, ["ts"])


def user_jumps(pages: DataFrame, gap_ms: int = 10_000) -> DataFrame:
    """Entry pages the visitor left without looking further."""
    return K.bounces(pages, "common.mid", P.entry_page(), "ts", ["ts"], gap_ms)


_VISIT_KEYS = ("vc", "ch", "ar", "is_new")


def _measures(rows: DataFrame, uv=0, sv=0, pv=0, dur=0, uj=0) -> DataFrame:
    """Any of the three page topics as one metric row."""

    def number(x) -> Column:
        return (x if isinstance(x, Column) else F.lit(x)).cast("bigint")

    values = {"uv_ct": uv, "sv_ct": sv, "pv_ct": pv, "dur_sum": dur, "uj_ct": uj}
    return rows.select(
        at("ts").alias("rt"),
        *[F.col(f"common.{k}").alias(k) for k in _VISIT_KEYS],
        *[number(v).alias(n) for n, v in values.items()],
    )


def _traffic_sums(rows: DataFrame, length: str, delay: str) -> DataFrame:
    sums = {n: F.col(n) for n in ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")}
    return window_sums(rows, "rt", sums, _VISIT_KEYS, length, delay)


def traffic(
    pages: DataFrame, visitors: DataFrame, jumps: DataFrame, length: str = WINDOW, delay: str = "14 seconds"
) -> DataFrame:
    """Visitors, sessions, pages, time and jumps per version, channel, area, is_new.

    From three topics; the delay covers the time a jump waits for its follower.
    """
    seen = _measures(pages, sv=_flag(P.entry_page()), pv=1, dur=F.col("page.during_time"))
    rows = seen.unionByName(_measures(visitors, uv=1)).unionByName(_measures(jumps, uj=1))
    return _traffic_sums(rows, length, delay)


def traffic_of(pages: DataFrame, length: str = WINDOW, gap_ms: int = 10_000) -> DataFrame:
    """`traffic` straight from a page table; pages and jumps share one pass."""
    narrow = pages.select("common", "page", "ts")
    marked = K.mark_bounces(narrow, "common.mid", P.entry_page(), "ts", ["ts"], gap_ms)
    seen = _measures(
        marked, sv=_flag(P.entry_page()), pv=1, dur=F.col("page.during_time"), uj=_flag(F.col("bounced"))
    )
    return _traffic_sums(seen.unionByName(_measures(unique_visitors(narrow), uv=1)), length, "14 seconds")
