"""Row changes to fact rows.  Facts made of several tables have a form for tables and a time-bounded one for streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import predicates as P
from ..functions.timefmt import date_id
from .joins import hot_key_join, stream_join, with_dictionary
from .keyed import last_per


def fields(*keys: str, **renamed: str) -> list[Column]:
    """Columns out of the `data` map; `renamed` gives new name = key."""
    same = [P.new(k).alias(k) for k in keys]
    return same + [P.new(k).alias(n) for n, k in renamed.items()]


#: A change feed: all tables in one, or one feed per table.
Changes = DataFrame | Mapping[str, DataFrame]


def changes_of(changes: Changes, table: str, *types: str, database: str | None = None) -> DataFrame:
    feed = changes if isinstance(changes, DataFrame) else changes[table]
    return feed.where(P.is_table(table, *types, database=database))


# --- facts of one table ----------------------------------------------------
def comments(changes: Changes, dictionary: DataFrame) -> DataFrame:
    rows = changes_of(changes, "comment_info", "insert").select(
        *fields("id", "user_id", "sku_id", "order_id"),
        date_id(P.new("create_time")).alias("date_id"),
        *fields("create_time", appraise_code="appraise"),
        "ts",
    )
    named = with_dictionary(rows, dictionary, "appraise_code", "appraise_name")
    return named.select(*rows.columns[:-1], "appraise_name", "ts")


def favours(changes: Changes) -> DataFrame:
    again = P.is_type("update") & (P.new("is_cancel") == "0")
    return changes_of(changes, "favor_info").where(P.is_type("insert") | again).select(
        *fields("id", "user_id", "sku_id"),
        date_id(P.new("create_time")).alias("date_id"),
        *fields("create_time"),
        "ts",
    )


def _coupon_rows(rows: DataFrame, when: str, name: str, order_id: bool) -> DataFrame:
    keys = ["id", "coupon_id", "user_id"] + (["order_id"] if order_id else [])
    return rows.select(
        *fields(*keys), date_id(P.new(when)).alias("date_id"), P.new(when).alias(name), "ts"
    )


def coupons_received(changes: Changes) -> DataFrame:
    return _coupon_rows(changes_of(changes, "coupon_use", "insert"), "get_time", "get_time", False)


def coupons_ordered(changes: Changes) -> DataFrame:
    moved = P.transition("coupon_status", "1401", "1402")
    return _coupon_rows(changes_of(changes, "coupon_use").where(moved), "using_time", "order_time", True)


def coupons_paid(changes: Changes, strict: bool = False) -> DataFrame:
    """Updates of a coupon that has a use time; `strict` keeps the one that set it.

    Without `strict` every later update of a paid coupon counts again.
    """
    rows = changes_of(changes, "coupon_use", "update").where(P.new("used_time").isNotNull())
    if strict:
        rows = rows.where(F.map_contains_key("old", "used_time"))
    return _coupon_rows(rows, "used_time", "payment_time", True)


def registrations(changes: Changes) -> DataFrame:
    return changes_of(changes, "user_info", "insert").select(
        *fields(user_id="id"),
        date_id(P.new("create_time")).alias("date_id"),
        *fields("create_time"),
        "ts",
    )


def cart_adds(changes: Changes, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Goods put into the cart; an update counts with the number added."""
    added = changes_of(changes, "cart_info", database=database).where(P.is_type("insert") | P.grew("sku_num"))
    keys = [k for k in schemas.CART_KEYS if k not in ("sku_num", "source_type")]
    rows = added.select(*fields(*keys, source_type_id="source_type"), P.growth("sku_num").alias("sku_num"))
    return with_dictionary(rows, dictionary, "source_type_id", "source_type_name").select(*schemas.CART_ADD)


# --- orders ----------------------------------------------------------------
def _change_time() -> Column:
    return F.timestamp_seconds(F.col("ts").try_cast("bigint"))


_ACTIVITY = {"activity_id": "activity_id", "activity_rule_id": "activity_rule_id", "order_detail_activity_id": "id"}
_COUPON = {"coupon_id": "coupon_id", "coupon_use_id": "coupon_use_id", "order_detail_coupon_id": "id"}


def _line_extras(activity: DataFrame, coupon: DataFrame) -> DataFrame:
    """Newest activity and coupon of each order line, in one aggregate."""

    def version(columns: dict[str, str]) -> Column:
        return F.struct(P.new("create_time").alias("made"), *[P.new(k).alias(n) for n, k in columns.items()])

    a = activity.select(P.new("order_detail_id").alias("id"), version(_ACTIVITY).alias("activity"))
    c = coupon.select(P.new("order_detail_id").alias("id"), version(_COUPON).alias("coupon"))
    # A line has about one of each, so nothing is gained by sorting and merging them before the shuffle.
    both = a.unionByName(c, allowMissingColumns=True).repartition("id").groupBy("id")
    newest = both.agg(F.max("activity").alias("activity"), F.max("coupon").alias("coupon"))
    return newest.select(
        "id", *[F.col(f"activity.{n}") for n in _ACTIVITY], *[F.col(f"coupon.{n}") for n in _COUPON]
    )


def _order_versions(changes: Changes, database: str | None) -> DataFrame:
    order_keys = [k for k in schemas.ORDER_INFO_KEYS if k not in ("id", "create_time")]
    return changes_of(changes, "order_info", "insert", "update", database=database).select(
        *fields(*order_keys, _order="id"), "type", "old", _change_time().alias("_order_ts")
    )


def _lines_of(changes: Changes, dictionary: DataFrame, database: str | None, orders: DataFrame, few: bool = False) -> DataFrame:
    """Order lines with their extras and `orders`; `few` orders are joined first, so that only their lines move again."""
    lines = changes_of(changes, "order_detail", "insert", database=database).select(
        *fields(*schemas.ORDER_DETAIL_KEYS), _change_time().alias("_line_ts")
    )
    extras = _line_extras(
        changes_of(changes, "order_detail_activity", "insert", database=database),
        changes_of(changes, "order_detail_coupon", "insert", database=database),
    )
    named = with_dictionary(
        lines.withColumnRenamed("source_type", "source_type_id"), dictionary, "source_type_id", "source_type_name"
    )
    same = F.col("order_id") == F.col("_order")
    joined = hot_key_join(named.join(orders, same), extras, ["id"], "left") if few else hot_key_join(named, extras, ["id"], "left").join(orders, same)
    return joined.withColumn("row_op_ts", F.greatest("_line_ts", "_order_ts"))


def order_wide(changes: Changes, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Wide order lines, one row per (line, order version).

    Activity and coupon rows are read as keyed tables (latest row per line), so
    a replayed change cannot multiply lines.  They are brought together first,
    narrow as they are, so the lines are shuffled once for both; the order
    columns are joined last and move once.
    `row_op_ts` is the time of the newest change a row was made from.
    """
    return _lines_of(changes, dictionary, database, _order_versions(changes, database)).select(*schemas.ORDER_WIDE)


def _parts(rows: DataFrame, kind: str, key: str, payload: list[Column], line: str | None = None, version: list[str] = ()) -> DataFrame:
    """Changes as parts of an order's state; the row's columns go as one JSON text, so all kinds share one stream."""
    return rows.select(
        P.new(key).alias("order_id"),
        F.lit(kind).alias("kind"),
        (P.new(line) if line else F.lit(None).cast("string")).alias("line"),
        F.concat_ws("\u0000", *[F.coalesce(P.new(c), F.lit("")) for c in version]).alias("version"),
        F.to_json(F.struct(*payload)).alias("payload"),
        _change_time().alias("at"),
    ).where("order_id is not null and at is not null")


def stream_order_wide(
    changes: Changes,
    dictionary: DataFrame,
    database: str | None = None,
    extras_within: str = "5 seconds",
    order_within: str = "5 seconds",
    delay: str = "2 seconds",
    versions: Column | None = None,
) -> DataFrame:
    """The same rows for streams: lines, extras and order versions meet in one keyed state, within bounds of the changes' times.

    A line takes the newest activity and coupon within `extras_within` of its own
    change and every order version within `order_within`; then its state goes
    (see `streaming.keyed.OrderLines`).  A join of four streams would chain two
    outer joins, whose watermarks hold rows back for good.  Changes of orders for
    which `versions` does not hold are left out before the state.  A replayed change
    repeats rows, so the sink keeps the newest row per line (`sinks.upsert_writer`).
    """
    from ..streaming import keyed as K

    order_keys = [k for k in schemas.ORDER_INFO_KEYS if k not in ("id", "create_time")]
    lines = changes_of(changes, "order_detail", "insert", database=database)
    orders = changes_of(changes, "order_info", "insert", "update", database=database)
    if versions is not None:
        orders = orders.where(versions)
    parts = _parts(lines, K.LINE, "order_id", fields(*schemas.ORDER_DETAIL_KEYS), "id")
    parts = parts.unionByName(_parts(orders, K.ORDER, "id", [*fields(*order_keys), F.col("type"), F.col("old")]))
    for table, kind, columns in (("order_detail_activity", K.ACTIVITY, _ACTIVITY), ("order_detail_coupon", K.COUPON, _COUPON)):
        extra = changes_of(changes, table, "insert", database=database)
        newest = ["create_time", *columns.values()]
        parts = parts.unionByName(_parts(extra, kind, "order_id", fields(**columns), "order_detail_id", newest))
    joined = K.order_lines(parts, extras_within, order_within, delay)

    def texts(names) -> str:
        return ", ".join(f"{n} string" for n in names)

    old = "old map<string, string>"
    rows = joined.select(
        "line_ms",
        "order_ms",
        F.from_json("line", texts(schemas.ORDER_DETAIL_KEYS)).alias("l"),
        F.from_json("activity", texts(_ACTIVITY)).alias("a"),
        F.from_json("coupon", texts(_COUPON)).alias("c"),
        F.from_json("order", f"{texts([*order_keys, 'type'])}, {old}").alias("o"),
    )
    rows = rows.select("l.*", "a.*", "c.*", "o.*", F.timestamp_millis(F.greatest("line_ms", "order_ms")).alias("row_op_ts"))
    rows = rows.withColumnRenamed("source_type", "source_type_id")
    return with_dictionary(rows, dictionary, "source_type_id", "source_type_name").select(*schemas.ORDER_WIDE)


def is_new_order() -> Column:
    return P.is_type("insert")


def is_cancellation(status: Column) -> Column:
    """Of an order's change, where `status` is the order's new one."""
    return P.is_type("update") & P.before("order_status").isNotNull() & (status == "1003")


def order_details(wide: DataFrame) -> DataFrame:
    return wide.where(is_new_order()).select(*schemas.ORDER_DETAIL)


def cancelled_details(wide: DataFrame) -> DataFrame:
    return wide.where(is_cancellation(F.col("order_status"))).withColumnRenamed("operate_time", "cancel_time").select(*schemas.CANCEL_DETAIL)


def order_cancellations(changes: Changes, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """`cancelled_details` of `order_wide`, from the cancelled orders on: only their lines are shuffled for the extras."""
    return cancelled_details(_lines_of(changes, dictionary, database, _order_versions(changes, database), few=True))


def _payments(changes: Changes, dictionary: DataFrame) -> DataFrame:
    paid = changes_of(changes, "payment_info", "update").where(P.new("payment_status") == "1602")
    payments = paid.select(
        *fields("callback_time", _order="order_id", payment_type_code="payment_type"), _change_time().alias("_paid_ts")
    )
    return with_dictionary(payments, dictionary, "payment_type_code", "payment_type_name")


def _payable(details: DataFrame) -> DataFrame:
    lines = details.withColumnRenamed("id", "order_detail_id")
    return lines.withColumnRenamed("split_total_amount", "split_payment_amount")


def paid_details(changes: Changes, details: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid order lines, one row per line: a later update of a paid payment replaces the row."""
    newest = last_per(_payments(changes, dictionary), ["_order"], ["_paid_ts", "callback_time", "payment_type_code"])
    return hot_key_join(_payable(details).withColumn("_order", F.col("order_id")), newest, ["_order"]).select(*schemas.PAY_DETAIL)


def order_payments(changes: Changes, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """`paid_details` of `order_details`, from the paid orders on.

    Payments are brought to the orders, narrow as both are; lines are shuffled
    once for both, and only the paid ones again for their extras.
    """
    newest = last_per(_payments(changes, dictionary), ["_order"], ["_paid_ts", "callback_time", "payment_type_code"])
    orders = hot_key_join(_order_versions(changes, database).where(P.is_type("insert")), newest, ["_order"])
    return _payable(_lines_of(changes, dictionary, database, orders, few=True)).select(*schemas.PAY_DETAIL)


def stream_paid_details(
    changes: Changes, details: DataFrame, dictionary: DataFrame, within: str = "905 seconds", delay: str = "2 seconds"
) -> DataFrame:
    """Paid order lines of streams; a payment is looked for within a time of the line's `row_op_ts`.

    Written by `sinks.upsert_writer` on `order_detail_id` and `_paid_ts`, which gives one row per line.
    """
    same = F.expr("order_id = _order")
    rows = stream_join(_payable(details), _payments(changes, dictionary), same, "row_op_ts", "_paid_ts", within, within, delay=delay)
    return rows.select(*schemas.PAY_DETAIL, "_paid_ts")


def _refunds(changes: Changes, dictionary: DataFrame) -> DataFrame:
    refunds = changes_of(changes, "order_refund_info", "insert").select(
        *fields(
            "id",
            "user_id",
            "order_id",
            "sku_id",
            "create_time",
            "refund_reason_txt",
            "refund_num",
            "refund_amount",
            refund_type_code="refund_type",
            refund_reason_type_code="refund_reason_type",
        ),
        date_id(P.new("create_time")).alias("date_id"),
        "ts",
        _change_time().alias("_refund_ts"),
    )
    named = with_dictionary(refunds, dictionary, "refund_type_code", "refund_type_name")
    return with_dictionary(named, dictionary, "refund_reason_type_code", "refund_reason_type_name")


def _orders_in(changes: Changes, status: str, *keys: str) -> DataFrame:
    orders = changes_of(changes, "order_info").where(P.changed_to("order_status", status))
    return orders.select(*fields(*keys, _order="id"), _change_time().alias("_order_ts"))


_SAME_ORDER = "order_id = _order"


def refund_requests(changes: Changes, dictionary: DataFrame) -> DataFrame:
    rows = _refunds(changes, dictionary).join(_orders_in(changes, "1005", "province_id"), F.expr(_SAME_ORDER))
    return rows.withColumn("row_op_ts", F.greatest("_refund_ts", "_order_ts")).select(*schemas.REFUND_DETAIL)


def stream_refund_requests(
    changes: Changes, dictionary: DataFrame, within: str = "5 seconds", delay: str = "2 seconds"
) -> DataFrame:
    """Refund requests of streams; the order's change is looked for within a time of the request's."""
    orders = _orders_in(changes, "1005", "province_id")
    rows = stream_join(
        _refunds(changes, dictionary), orders, F.expr(_SAME_ORDER), "_refund_ts", "_order_ts", within, within, delay=delay
    )
    return rows.withColumn("row_op_ts", F.greatest("_refund_ts", "_order_ts")).select(*schemas.REFUND_DETAIL)


def _refund_parts(changes: Changes, dictionary: DataFrame, strict: bool) -> tuple[DataFrame, DataFrame]:
    """Refund payments, and the refund requests they belong to."""
    payment = changes_of(changes, "refund_payment")
    refund = changes_of(changes, "order_refund_info")
    if strict:
        payment = payment.where(P.changed_to("refund_status", "0702"))
        refund = refund.where(P.changed_to("refund_status", "0705"))
    paid = payment.select(
        *fields(
            "id",
            "order_id",
            "sku_id",
            "callback_time",
            payment_type_code="payment_type",
            refund_amount="total_amount",
        ),
        date_id(P.new("callback_time")).alias("date_id"),
        "ts",
        _change_time().alias("_paid_ts"),
    )
    requested = refund.select(
        *fields("refund_num", _request="id", _of_order="order_id", _of_sku="sku_id"), _change_time().alias("_request_ts")
    )
    return with_dictionary(paid, dictionary, "payment_type_code", "payment_type_name"), requested


_SAME_REFUND = "order_id = _of_order and sku_id = _of_sku"


def refunds_paid(changes: Changes, dictionary: DataFrame, strict: bool = False) -> DataFrame:
    """Paid refunds; `strict` also asks for the status changes 0702 and 0705.

    Replays of a request are told by its own id: two requests for one order and
    goods are two rows for each payment.
    """
    paid, requested = _refund_parts(changes, dictionary, strict)
    requested = last_per(requested, ["_request"], ["_request_ts", "refund_num"])
    orders = _orders_in(changes, "1006", "user_id", "province_id")
    return (
        paid.join(requested, F.expr(_SAME_REFUND))
        .join(orders, F.expr(_SAME_ORDER))
        .withColumn("row_op_ts", F.greatest("_paid_ts", "_order_ts"))
        .select(*schemas.REFUND_PAID)
    )


def stream_refunds_paid(
    changes: Changes, dictionary: DataFrame, strict: bool = False, within: str = "5 seconds", delay: str = "2 seconds"
) -> DataFrame:
    """Paid refunds of streams, all three changes within a time of the payment's.

    Orders are joined first: few are refunded, so few payments go on to the requests.
    Replays are left to the upsert sink, whose keys are `id` and `_request`, the request's own id.
    """
    paid, requested = _refund_parts(changes, dictionary, strict)
    orders = _orders_in(changes, "1006", "user_id", "province_id")
    rows = stream_join(paid, orders, F.expr(_SAME_ORDER), "_paid_ts", "_order_ts", within, within, delay=delay)
    rows = rows.withColumn("row_op_ts", F.greatest("_paid_ts", F.timestamp_micros(F.unix_micros("_order_ts")))).drop("_order_ts")
    rows = stream_join(rows, requested, F.expr(_SAME_REFUND), "_paid_ts", "_request_ts", within, within, delay=delay)
    return rows.select(*schemas.REFUND_PAID, "_request")
