"""The dated reports.

Inputs are metric tables; `date` is `yyyyMMdd`, today by default.  A table
partitioned by `dt` is pruned to one partition, any other is filtered on the
window start text, which parquet can skip on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import compact_day, today
from ..operators.windows import amount

# Fixed weights of the keyword sources.
KEYWORD_WEIGHTS = {"SEARCH": 10, "ORDER": 5, "CART": 2, "CLICK": 1}


def on_day(metric: DataFrame, date: int | None) -> DataFrame:
    start, end = compact_day(date or today())
    if "dt" in metric.columns:
        return metric.where(F.col("dt") == start[:10])
    return metric.where((F.col("stt") >= start) & (F.col("stt") < end))


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0).cast("bigint"))


def _amount_sum(name: str) -> Column:
    return amount(F.sum(F.col(name).cast("decimal(18,2)")))


def _stack(df: DataFrame, key: str, value: str, columns: dict[str, str]) -> DataFrame:
    """One row of totals to one row per label."""
    pairs = F.array(*[F.struct(F.lit(k).alias(key), F.col(c).alias(value)) for k, c in columns.items()])
    return df.select(F.explode(pairs).alias("p")).select("p.*")


# --- activity and coupon ---------------------------------------------------
def _subsidy(orders: DataFrame, date: int | None, column: str, rate: str) -> DataFrame:
    day = on_day(orders, date).groupBy(F.substring("stt", 1, 10).alias("day"))
    sums = day.agg(
        _amount_sum(f"order_{column}").alias(column),
        _amount_sum("order_origin_total_amount").alias("origin_total_amount"),
    )
    ratio = F.try_divide(F.round(column, 5), F.round("origin_total_amount", 5))
    return sums.select(column, "origin_total_amount", F.round(ratio, 20).alias(rate))


def activity_subsidy(orders: DataFrame, date: int | None = None) -> DataFrame:
    return _subsidy(orders, date, "activity_reduce_amount", "subsidy_rate")


def coupon_subsidy(orders: DataFrame, date: int | None = None) -> DataFrame:
    return _subsidy(orders, date, "coupon_reduce_amount", "coupon_subsidy_rate")


# --- goods -----------------------------------------------------------------
def top_trademarks(spu_orders: DataFrame, date: int | None = None, limit: int = 5) -> DataFrame:
    """Trademarks by amount; equal amounts go by name."""
    sums = on_day(spu_orders, date).groupBy("trademark_name").agg(_amount_sum("order_amount").alias("order_amount"))
    return sums.orderBy(F.desc("order_amount"), "trademark_name").limit(limit)


def _orders_and_refunds(spu_orders: DataFrame, refunds: DataFrame, date: int | None, ids: list[str], names: list[str]) -> DataFrame:
    """Order and refund figures side by side; either side may be missing."""
    groups = [*ids, *names]
    ordered = on_day(spu_orders, date).groupBy(*groups).agg(
        F.sum("order_count").alias("order_count"),
        F.count_distinct("user_id").alias("uu_count"),
        _amount_sum("order_amount").alias("order_amount"),
    )
    returned = on_day(refunds, date).groupBy(*groups).agg(
        F.sum("refund_count").alias("refund_count"),
        F.count_distinct("user_id").alias("refund_uu_count"),
    )
    for n in names:
        returned = returned.withColumnRenamed(n, f"_{n}")
    counts = ("order_count", "uu_count", "refund_count", "refund_uu_count")
    joined = ordered.join(returned, ids, "full")
    zero = {c: 0 for c in counts} | {"order_amount": 0.0}
    return joined.select(
        *[F.coalesce(n, f"_{n}").alias(n) for n in names],
        "order_count",
        "uu_count",
        "order_amount",
        "refund_count",
        "refund_uu_count",
    ).fillna(zero)


def trademark_orders_refunds(spu_orders: DataFrame, refunds: DataFrame, date: int | None = None) -> DataFrame:
    return _orders_and_refunds(spu_orders, refunds, date, ["trademark_id"], ["trademark_name"])


def category_orders_refunds(spu_orders: DataFrame, refunds: DataFrame, date: int | None = None) -> DataFrame:
    levels = ("category1", "category2", "category3")
    return _orders_and_refunds(
        spu_orders, refunds, date, [f"{c}_id" for c in levels], [f"{c}_name" for c in levels]
    )


def trademark_amounts(spu_orders: DataFrame, date: int | None = None) -> DataFrame:
    sums = on_day(spu_orders, date).groupBy("trademark_id", "trademark_name")
    return sums.agg(_amount_sum("order_amount").alias("order_amount")).drop("trademark_id")


def spu_stats(spu_orders: DataFrame, date: int | None = None) -> DataFrame:
    sums = on_day(spu_orders, date).groupBy("spu_id", "spu_name").agg(
        F.sum("order_count").alias("order_count"),
        F.count_distinct("user_id").alias("uu_count"),
        _amount_sum("order_amount").alias("order_amount"),
    )
    return sums.drop("spu_id")


# --- trade -----------------------------------------------------------------
def total_amount(province_orders: DataFrame, date: int | None = None) -> DataFrame:
    day = on_day(province_orders, date).groupBy(F.substring("stt", 1, 10).alias("day"))
    return day.agg(_amount_sum("order_amount").alias("order_total_amount")).drop("day")


def trade_stats(spu_orders: DataFrame, refunds: DataFrame, date: int | None = None) -> DataFrame:
    """Orders, ordering users, refunds, refunding users.

    An order with several spus counts once per spu, as the metric rows do.
    """
    ordered = on_day(spu_orders, date).agg(
        _total("order_count").alias("n"), F.count_distinct("user_id").alias("users")
    )
    returned = on_day(refunds, date).agg(
        _total("refund_count").alias("n"), F.count_distinct("user_id").alias("users")
    )
    return _stack(ordered, "type", "value", {"order_count": "n", "order_users": "users"}).unionByName(
        _stack(returned, "type", "value", {"refund_count": "n", "refund_users": "users"})
    )


def province_order_counts(province_orders: DataFrame, date: int | None = None) -> DataFrame:
    sums = on_day(province_orders, date).groupBy("province_id", "province_name")
    return sums.agg(F.sum("order_count").alias("order_count")).drop("province_id")


def province_order_amounts(province_orders: DataFrame, date: int | None = None) -> DataFrame:
    named = on_day(province_orders, date).where(F.col("province_name").isNotNull() & (F.col("province_name") != ""))
    sums = named.groupBy("province_id", "province_name")
    return sums.agg(_amount_sum("order_amount").alias("order_amount")).drop("province_id")


# --- traffic ---------------------------------------------------------------
def _per_channel(traffic: DataFrame, date: int | None, name: str, value: Column) -> DataFrame:
    return on_day(traffic, date).groupBy("ch").agg(value.alias(name)).orderBy(F.desc(name), "ch")


def _ratio(top: str, bottom: str) -> Column:
    return F.try_divide(F.sum(top), F.sum(bottom))


def channel_visitors(traffic: DataFrame, date: int | None = None) -> DataFrame:
    return _per_channel(traffic, date, "uv_ct", F.sum("uv_ct"))


def channel_sessions(traffic: DataFrame, date: int | None = None) -> DataFrame:
    return _per_channel(traffic, date, "sv_ct", F.sum("sv_ct"))


def pages_per_session(traffic: DataFrame, date: int | None = None) -> DataFrame:
    return _per_channel(traffic, date, "pv_per_session", _ratio("pv_ct", "sv_ct"))


def time_per_session(traffic: DataFrame, date: int | None = None) -> DataFrame:
    return _per_channel(traffic, date, "dur_per_session", _ratio("dur_sum", "sv_ct"))


def jump_rate(traffic: DataFrame, date: int | None = None) -> DataFrame:
    return _per_channel(traffic, date, "uj_rate", _ratio("uj_ct", "sv_ct"))


def keyword_scores(keywords: DataFrame, date: int | None = None) -> DataFrame:
    weight = F.lit(0)
    for source, points in KEYWORD_WEIGHTS.items():
        weight = F.when(F.upper("source") == source, points).otherwise(weight)
    sums = on_day(keywords, date).groupBy("keyword").agg(F.sum(F.col("keyword_count") * weight).alias("keyword_score"))
    return sums.orderBy(F.desc("keyword_score"), "keyword")


def visitor_types(traffic: DataFrame, date: int | None = None) -> DataFrame:
    """Five figures for new and old visitors; a kind without rows shows zeros."""
    counts = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
    sums = on_day(traffic, date).agg(
        *[
            F.coalesce(F.sum(F.when(rule, F.col(c))), F.lit(0)).alias(f"{kind}_{c}")
            for kind, rule in (("new", F.col("is_new") == "1"), ("old", F.col("is_new") != "1"))
            for c in counts
        ]
    )

    def row(name: str, figure) -> Column:
        return F.struct(F.lit(name).alias("type"), figure("new").alias("new"), figure("old").alias("old"))

    def count(c: str):
        return lambda kind: F.col(f"{kind}_{c}").cast("double")

    def per_session(c: str, scale: int = 1):
        def figure(kind: str) -> Column:
            sessions = F.col(f"{kind}_sv_ct")
            return F.when(sessions == 0, 0.0).otherwise(F.try_divide(F.col(f"{kind}_{c}"), sessions) / scale)

        return figure

    rows = [
        row("uv", count("uv_ct")),
        row("pv", count("pv_ct")),
        row("uj_rate", per_session("uj_ct")),
        row("avg_dur", per_session("dur_sum", 1000)),
        row("avg_pv", per_session("pv_ct")),
    ]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def visitors_per_hour(traffic: DataFrame, date: int | None = None) -> DataFrame:
    """All 24 hours of the day, hours without rows as zeros."""
    hourly = on_day(traffic, date).groupBy(F.substring("stt", 12, 2).alias("hr")).agg(
        F.sum("uv_ct").alias("uv_ct"),
        F.sum("pv_ct").alias("pv_ct"),
        F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)).alias("new_uv_ct"),
    )
    hours = traffic.sparkSession.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))
    return hours.join(hourly, "hr", "left").fillna(0).orderBy("hr")


# --- users -----------------------------------------------------------------
def page_funnel(page_views: DataFrame, carts: DataFrame, orders: DataFrame, payments: DataFrame, date: int | None = None) -> DataFrame:
    def part(metric: DataFrame, columns: dict[str, str]) -> DataFrame:
        sums = on_day(metric, date).agg(*[_total(c).alias(c) for c in columns.values()])
        return _stack(sums, "page_id", "uv_ct", columns)

    return (
        part(page_views, {"home": "home_uv_ct", "good_detail": "good_detail_uv_ct"})
        .unionByName(part(carts, {"cart": "cart_add_uu_ct"}))
        .unionByName(part(orders, {"trade": "order_unique_user_count"}))
        .unionByName(part(payments, {"payment": "payment_suc_unique_user_count"}))
    )


def user_changes(logins: DataFrame, registers: DataFrame, date: int | None = None) -> DataFrame:
    seen = on_day(logins, date).agg(_total("back_ct").alias("back"), _total("uu_ct").alias("active"))
    fresh = on_day(registers, date).agg(_total("register_ct").alias("fresh"))
    return _stack(seen, "type", "user_ct", {"backCt": "back", "activeUserCt": "active"}).unionByName(
        _stack(fresh, "type", "user_ct", {"newUserCt": "fresh"})
    )


def new_traders(orders: DataFrame, payments: DataFrame, date: int | None = None) -> DataFrame:
    ordered = on_day(orders, date).agg(_total("order_new_user_count").alias("n"))
    paid = on_day(payments, date).agg(_total("payment_suc_new_user_count").alias("n"))
    return _stack(ordered, "trade_type", "user_ct", {"order": "n"}).unionByName(
        _stack(paid, "trade_type", "user_ct", {"payment": "n"})
    )


# --- chart series ----------------------------------------------------------
def chart_series(report: DataFrame, category: str, series: list[str], order: list[Column]) -> DataFrame:
    """A report as parallel arrays: categories and one array per series.

    Meant for finished reports: their rows are few (channels, hours, provinces,
    the top n), as the chart they feed.
    """
    keys = [c.alias(f"o{i}") for i, c in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*keys, category, *series)))
    packed = report.agg(rows.alias("rows"))

    def column(name: str) -> Column:
        return F.transform("rows", lambda r: r[name])

    return packed.select(column(category).alias("categories"), *[column(s).alias(s) for s in series])


def series_json(report: DataFrame, category: str, series: list[str], order: list[Column]) -> DataFrame:
    packed = chart_series(report, category, series, order)
    return packed.select(F.to_json(F.struct(*packed.columns)).alias("payload"))
