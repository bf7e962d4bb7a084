"""Every operator as a query over the given tables.

`events` are sparse (hours between two events of a user), so the time settings
here are longer than the defaults: windows of one hour or one day, a bounce gap
of six hours, a user is back after two days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.timefmt import at, day_text, leading_day, parse_stamp, stamp_text
from ..functions import tokens
from ..functions.tokens import split_words
from ..functions import predicates as P
from ..operators import dims as D
from ..operators import facts as X
from ..operators import joins as J
from ..operators import keyed as K
from ..operators import logsplit as L
from ..operators.parse import clean_rows, dirty_lines
from ..operators.windows import window_sums
from . import metrics as M
from . import reports as R
from . import table_feeds as A

Query = Callable[[SparkSession, str], DataFrame]

HOUR, DAY = "1 hour", "1 day"
GAP_MS = 6 * 3600 * 1000
BACK_DAYS = 2
DATE = 20240110

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- log -------------------------------------------------------------------
def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(A.raw_log(spark, sf_dir), schemas.LOG)


def _flat_common() -> list[Column]:
    return [F.col(f"common.{n}").alias(n) for n in "mid is_new vc ch ar uid".split()]


def _flat_page() -> list[Column]:
    return [F.col(f"page.{n}").alias(n) for n in "page_id last_page_id item item_type during_time".split()]


def _size(name: str) -> Column:
    return F.coalesce(F.size(name), F.lit(0)).cast("bigint").alias(f"n_{name}")


@query
def log_parse_clean(spark, sf_dir):
    return _logs(spark, sf_dir).select(
        *_flat_common(), *_flat_page(), "start", "err", _size("displays"), _size("actions"), "ts"
    )


@query
def log_parse_dirty(spark, sf_dir):
    return dirty_lines(A.raw_log(spark, sf_dir), schemas.LOG)


def _split(spark, sf_dir, part: str) -> DataFrame:
    return L.split_log(K.repair_new_flag(_logs(spark, sf_dir)))[part]


@query
def log_split_page(spark, sf_dir):
    return _split(spark, sf_dir, "page").select(*_flat_common(), *_flat_page(), "ts")


@query
def log_split_start(spark, sf_dir):
    return _split(spark, sf_dir, "start").select(*_flat_common(), "start", "ts")


@query
def log_split_display(spark, sf_dir):
    return _split(spark, sf_dir, "display").select(
        "common", "page_id", "ts", F.col("display")["item"].alias("item"), F.col("display")["order"].alias("pos")
    )


@query
def log_split_action(spark, sf_dir):
    return _split(spark, sf_dir, "action").select(
        "common", "page_id", "ts", F.col("action")["item"].alias("item"), F.col("action")["action_id"].alias("action_id")
    )


@query
def log_split_error(spark, sf_dir):
    return _split(spark, sf_dir, "error").select(
        *_flat_common(), *_flat_page(), "start", "err", _size("displays"), _size("actions"), "ts"
    )


# --- keyed rules -----------------------------------------------------------
@query
def is_new_repair(spark, sf_dir):
    return K.repair_new_flag(A.page_log(spark, sf_dir)).select("event_id", *_flat_common())


@query
def daily_unique_visitor(spark, sf_dir):
    return M.unique_visitors(A.page_log(spark, sf_dir)).select("event_id", "common.mid")


@query
def bounce_detail(spark, sf_dir):
    return M.user_jumps(A.page_log(spark, sf_dir), GAP_MS).select("event_id", "common.mid")


@query
def page_kind_uv(spark, sf_dir):
    pages = A.page_log(spark, sf_dir).where(P.home_or_detail())
    firsts = K.day_firsts(pages, ["common.mid", "page.page_id"], day_text(at("ts")), ["ts"])
    return firsts.select("event_id", "common.mid", "page.page_id")


def _carts(spark, sf_dir) -> DataFrame:
    return X.cart_adds(A.feeds(spark, sf_dir, "cart_info"), A.dictionary(spark, sf_dir), A.SHOP)


@query
def cart_unique_user(spark, sf_dir):
    text = F.coalesce("operate_time", "create_time")
    rows = _carts(spark, sf_dir).select("id", "user_id", text.alias("cart_time"), leading_day(text).alias("day"))
    return K.day_firsts(rows, "user_id", "day", ["cart_time", "id"])


@query
def login_back_user(spark, sf_dir):
    rows = A.page_log(spark, sf_dir).where(P.login_page())
    rows = rows.select("event_id", F.col("common.uid").alias("uid"), "ts", day_text(at("ts")).alias("day"))
    users = K.day_changes(rows, "uid", "day", ["ts"])
    back = F.when(F.col("days_away") >= BACK_DAYS, 1).otherwise(0).cast("bigint")
    return users.select("event_id", "uid", "day", back.alias("back"))


_ORDER_FEEDS = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")


def _wide(spark, sf_dir) -> DataFrame:
    return X.order_wide(A.feeds(spark, sf_dir, *_ORDER_FEEDS), A.dictionary(spark, sf_dir), A.SHOP)


def _details(spark, sf_dir) -> DataFrame:
    """Order details need only the inserts of the order feed."""
    return X.order_details(_wide(spark, sf_dir))


def _paid(spark, sf_dir) -> DataFrame:
    return X.order_payments(A.feeds(spark, sf_dir, *_ORDER_FEEDS, "payment_info"), A.dictionary(spark, sf_dir), A.SHOP)


_FIRST_ORDER = ["row_op_ts", "create_time", "sku_id", "sku_num", "order_price"]


@query
def order_user_flags(spark, sf_dir):
    lines = K.first_per(_details(spark, sf_dir), "id", _FIRST_ORDER).select(
        "id", "user_id", "create_time", parse_stamp("create_time").alias("rt"), leading_day("create_time").alias("day")
    )
    return K.user_flags(lines, "user_id", "day", "rt", ["rt", "id"], block=HOUR).drop("rt")


@query
def payment_user_flags(spark, sf_dir):
    lines = K.last_per(
        _paid(spark, sf_dir), "order_detail_id", ["row_op_ts", "callback_time", "sku_id", "sku_num"]
    ).select("order_detail_id", "user_id", "callback_time", leading_day("callback_time").alias("day"))
    users = K.day_changes(lines, "user_id", "day", ["callback_time", "order_detail_id"])
    return users.where("is_first").select("order_detail_id", "user_id", "callback_time")


@query
def dedup_first(spark, sf_dir):
    return K.first_per(_details(spark, sf_dir), "id", _FIRST_ORDER).select(
        "id", "create_time", "sku_id", "sku_num", "order_price"
    )


@query
def dedup_first_ttl(spark, sf_dir):
    return K.first_wins_within(
        A.page_log(spark, sf_dir), "common.mid", "ts", ["ts"], GAP_MS
    ).select("event_id", "common.mid")


@query
def dedup_last(spark, sf_dir):
    rows = K.last_per(_details(spark, sf_dir), "id", _FIRST_ORDER)
    return rows.select("id", "create_time", "sku_id", "sku_num", "order_price")


# --- row changes -----------------------------------------------------------
@query
def cdc_route(spark, sf_dir):
    # Cut to the id table by table, so no change's whole map is made.
    rows = A.changes(spark, sf_dir).select("table", "type", P.new("id").alias("id"))
    return rows.groupBy("table", "type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


@query
def cdc_changed_to(spark, sf_dir):
    rows = A.feeds(spark, sf_dir, "order_info")["order_info"].where(P.changed_to("order_status", "1003"))
    return rows.select(*X.fields("id", "user_id", "order_status", "operate_time"), P.before("order_status").alias("old_status"))


@query
def cdc_transition(spark, sf_dir):
    return X.coupons_ordered(A.feeds(spark, sf_dir, "coupon_use"))


@query
def cdc_favor(spark, sf_dir):
    return X.favours(A.feeds(spark, sf_dir, "favor_info"))


@query
def cdc_coupon_get(spark, sf_dir):
    return X.coupons_received(A.feeds(spark, sf_dir, "coupon_use"))


@query
def cdc_coupon_pay(spark, sf_dir):
    return X.coupons_paid(A.feeds(spark, sf_dir, "coupon_use"))


@query
def cdc_coupon_pay_strict(spark, sf_dir):
    return X.coupons_paid(A.feeds(spark, sf_dir, "coupon_use"), strict=True)


@query
def cdc_cart_delta(spark, sf_dir):
    return _carts(spark, sf_dir)


@query
def user_register(spark, sf_dir):
    return X.registrations(A.feeds(spark, sf_dir, "user_info"))


@query
def comment_fact(spark, sf_dir):
    return X.comments(A.feeds(spark, sf_dir, "comment_info"), A.dictionary(spark, sf_dir))


def _shown(df: DataFrame) -> DataFrame:
    """Time columns as text, the old map as its one value."""
    if "row_op_ts" in df.columns:
        df = df.withColumn("row_op_ts", stamp_text("row_op_ts"))
    if "old" in df.columns:
        df = df.withColumn("old", P.before("order_status"))
    return df


@query
def order_wide(spark, sf_dir):
    return _shown(_wide(spark, sf_dir))


@query
def order_detail(spark, sf_dir):
    return _shown(_details(spark, sf_dir))


@query
def order_cancel(spark, sf_dir):
    return X.order_cancellations(A.feeds(spark, sf_dir, *_ORDER_FEEDS), A.dictionary(spark, sf_dir), A.SHOP)


@query
def pay_detail(spark, sf_dir):
    return _shown(_paid(spark, sf_dir))


def _refunds(spark, sf_dir) -> DataFrame:
    rows = A.feeds(spark, sf_dir, "order_info", "order_refund_info")
    return X.refund_requests(rows, A.dictionary(spark, sf_dir))


@query
def refund_detail(spark, sf_dir):
    return _shown(_refunds(spark, sf_dir))


@query
def refund_paid(spark, sf_dir):
    rows = A.feeds(spark, sf_dir, "order_info", "order_refund_info", "refund_payment")
    return _shown(X.refunds_paid(rows, A.dictionary(spark, sf_dir)))


# --- dimensions ------------------------------------------------------------
@query
def dim_route(spark, sf_dir):
    routed = D.route(A.changes(spark, sf_dir), A.routing(spark))
    keys = F.array_join(F.array_sort(F.map_keys("data")), ",")
    return routed.select("sink_table", "pk", "type", keys.alias("kept"), "ts")


@query
def dim_prune(spark, sf_dir):
    routed = D.route(A.changes(spark, sf_dir, "sku_info"), A.routing(spark))
    return routed.select(*X.fields("id", "sku_name", "sku_desc", "tm_id"), "type")


@query
def dim_upsert_latest(spark, sf_dir):
    latest = D.latest_dimensions(D.route(A.changes(spark, sf_dir, *A.DIMENSION_TABLES), A.routing(spark)))
    name = F.coalesce(*[P.new(c) for c in ("sku_name", "spu_name", "tm_name", "name")])
    return latest.select("sink_table", "pk", name.alias("name"))


def _lines_province(spark, sf_dir) -> DataFrame:
    rows = A.feeds(spark, sf_dir, "order_info")["order_info"].where(P.is_type("insert"))
    return rows.select(*X.fields("id", "user_id", "province_id"))


@query
def dim_enrich_inner(spark, sf_dir):
    return D.with_province(_lines_province(spark, sf_dir), A.dimensions(spark, sf_dir, "province"))


@query
def dim_enrich_left(spark, sf_dir):
    return D.with_province(_lines_province(spark, sf_dir), A.dimensions(spark, sf_dir, "province"), "left")


@query
def dim_snowflake(spark, sf_dir):
    dims = A.dimensions(spark, sf_dir)
    rows = A.feeds(spark, sf_dir, "order_detail")["order_detail"].select(*X.fields("id", "sku_id", "source_id", "create_time"))
    return D.with_categories(D.with_trademark(D.with_spu(D.with_sku(rows, dims), dims), dims), dims)


@query
def interval_join(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    at_time = F.col("ts").cast("timestamp")

    def side(kind: str, tag: str) -> DataFrame:
        rows = events.where(F.col("event_type") == kind)
        return rows.select("user_id", F.col("event_id").alias(f"{tag}_id"), at_time.alias(f"{tag}_ts"))

    pairs = J.interval_join(side("click", "click"), side("purchase", "buy"), "user_id", "click_ts", "buy_ts", HOUR, HOUR)
    return pairs.select("user_id", "click_id", "buy_id")


@query
def lookup_join(spark, sf_dir):
    rows = A.table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user"), "value")
    return J.with_dictionary(rows, A.dictionary(spark, sf_dir), "user", "dic_name")


@query
def word_count(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents").select("lang", "text")
    words = split_words(docs, "text").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return words


@query
def dictionary_words(spark, sf_dir):
    """Words of a lexicon inside the words of all documents; the lexicon is what a fiftieth of the documents have."""
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    spread = split_words(docs, "text").where(F.length("word").between(2, 12)).select("doc_id", "word").distinct()
    common = spread.groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
    # Both are read several times, and each time would split all texts again.
    lexicon = A._stored(spark, "lexicon", common.where(F.col("docs") * 50 >= docs.count()).select("word"))
    # Runs are cut one by one, so equal ones are counted before and not joined by a frequent key.
    runs = A._stored(spark, "runs", word_count(spark, sf_dir).withColumnsRenamed({"word": "run", "n": "times"}))
    found = tokens.dictionary_words(runs, "run", lexicon, script=r"[\p{L}\p{N}]")
    return found.groupBy("lang", "word").agg(F.sum("times").alias("n"))


# --- window metrics --------------------------------------------------------
@query
def win_cart_uu(spark, sf_dir):
    return M.cart_add_uu(_carts(spark, sf_dir), HOUR)


@query
def win_order(spark, sf_dir):
    return M.order(_details(spark, sf_dir), HOUR)


@query
def win_payment(spark, sf_dir):
    return M.payment(_paid(spark, sf_dir), HOUR)


@query
def win_payment_returning(spark, sf_dir):
    return M.payment(_paid(spark, sf_dir), HOUR, include_returning=True)


@query
def win_province(spark, sf_dir):
    return M.province_order(_details(spark, sf_dir), A.dimensions(spark, sf_dir, "province"), HOUR)


@query
def win_refund(spark, sf_dir):
    return M.refund(_refunds(spark, sf_dir), A.dimensions(spark, sf_dir), DAY)


@query
def win_user_spu(spark, sf_dir):
    return M.user_spu_order(_details(spark, sf_dir), A.dimensions(spark, sf_dir), DAY)


@query
def win_page_uv(spark, sf_dir):
    return M.page_view(A.page_log(spark, sf_dir), HOUR)


@query
def win_keyword(spark, sf_dir):
    return M.keyword(A.page_log(spark, sf_dir), HOUR)


@query
def win_traffic(spark, sf_dir):
    return M.traffic_of(A.page_log(spark, sf_dir), HOUR, GAP_MS)


@query
def win_login(spark, sf_dir):
    return M.login(A.page_log(spark, sf_dir), HOUR, BACK_DAYS)


@query
def win_register(spark, sf_dir):
    return M.register(X.registrations(A.feeds(spark, sf_dir, "user_info")), HOUR)


@query
def win_ten_seconds(spark, sf_dir):
    """The default ten-second window, over all events."""
    rows = A.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("rt"), "event_type", "value")
    sums = {"n": F.lit(1).cast("bigint"), "total": F.col("value").cast("decimal(18,2)")}
    out = window_sums(rows, "rt", sums, ("event_type",))
    return out.withColumn("total", F.round(F.col("total").cast("double"), 2))


# --- reports ---------------------------------------------------------------
def _report(name: str, build: Callable[..., DataFrame], *sources: str, then=None) -> None:
    def run(spark, sf_dir):
        tables = [QUERIES[s](spark, sf_dir) for s in sources]
        out = build(*tables, DATE)
        return then(out) if then else out

    run.__name__ = name
    query(run)


_report("rep_activity_subsidy", R.activity_subsidy, "win_order")
_report("rep_coupon_subsidy", R.coupon_subsidy, "win_order")
_report("rep_top_trademarks", R.top_trademarks, "win_user_spu")
_report("rep_trademark_orders_refunds", R.trademark_orders_refunds, "win_user_spu", "win_refund")
_report("rep_trademark_amounts", R.trademark_amounts, "win_user_spu")
_report("rep_category_orders_refunds", R.category_orders_refunds, "win_user_spu", "win_refund")
_report("rep_spu_stats", R.spu_stats, "win_user_spu")
_report("rep_total_amount", R.total_amount, "win_province")
_report("rep_trade_stats", R.trade_stats, "win_user_spu", "win_refund")
_report("rep_province_counts", R.province_order_counts, "win_province")
_report("rep_province_amounts", R.province_order_amounts, "win_province")
_report("rep_channel_visitors", R.channel_visitors, "win_traffic")
_report("rep_channel_sessions", R.channel_sessions, "win_traffic")
_report("rep_pages_per_session", R.pages_per_session, "win_traffic")
_report("rep_time_per_session", R.time_per_session, "win_traffic")
_report("rep_jump_rate", R.jump_rate, "win_traffic")
_report("rep_keyword_scores", R.keyword_scores, "win_keyword")
_report("rep_visitor_types", R.visitor_types, "win_traffic")
_report("rep_visitors_per_hour", R.visitors_per_hour, "win_traffic")
_report("rep_page_funnel", R.page_funnel, "win_page_uv", "win_cart_uu", "win_order", "win_payment")
_report("rep_user_changes", R.user_changes, "win_login", "win_register")
_report("rep_new_traders", R.new_traders, "win_order", "win_payment")
_report(
    "rep_series",
    R.visitors_per_hour,
    "win_traffic",
    then=lambda df: R.series_json(df, "hr", ["uv_ct", "pv_ct", "new_uv_ct"], [F.col("hr")]),
)
