"""The two feeds and the dimensions, derived from star-schema tables.

`events` plays the application log, the order tables play the row changes, and
`part`, `nation` and `region` the dimensions.  Every row of a table takes part.
All times fall into January 2024: a row's own date, taken modulo 30 days, plus
seconds made from its keys.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import predicates as P
from ..operators.dims import category_tree
from ..operators.keyed import last_per
from ..session import work_folder

_START = "timestamp_ntz'2024-01-01 00:00:00'"


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the reader (not its rows) is kept, so footers are read once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- application log -------------------------------------------------------
# event_type -> page; event_id % 4 -> previous page
_PAGE = (
    "case event_type when 'view' then 'home' when 'click' then 'good_detail' when 'purchase' then 'trade' "
    "when 'signup' then 'login' else 'search' end"
)
_LAST = "case event_id % 4 when 1 then 'login' when 2 then 'search' when 3 then 'home' end"
_K = "cast(get_json_object(props, '$.k') as int)"


def log_of(events: DataFrame) -> DataFrame:
    """Typed log records of an `events` table or stream, with `event_id`."""
    rows = events.selectExpr("*", f"{_K} as k", f"{_PAGE} as page_id", f"{_LAST} as last_page_id")
    return rows.selectExpr(
        "named_struct('mid', cast(user_id as string), 'is_new', if(k % 2 = 0, '1', '0'), "
        "'vc', concat('v', user_id % 3), 'ch', concat('ch', event_id % 5), 'ar', concat('ar', user_id % 7), "
        "'uid', if(event_id % 5 = 0, null, cast(user_id as string)), "
        "'ba', cast(null as string), 'md', cast(null as string), 'os', cast(null as string)) as common",
        "named_struct('page_id', page_id, 'last_page_id', last_page_id, "
        "'item', if(k % 10 = 9, null, concat(event_type, ' Brand', k % 7, ' k', k)), "
        "'item_type', if(last_page_id = 'search' and k % 3 <> 0, 'keyword', 'sku_id'), "
        "'source_type', cast(null as string), "
        "'during_time', cast(round(value * 1000) as bigint)) as page",
        "if(event_id % 11 = 0, concat('{\"entry\":\"icon\",\"loading_time\":', k, '}'), null) as start",
        "transform(sequence(1, k % 3), i -> map('item', concat('sku', i), 'order', cast(i as string)))"
        " as displays",
        "transform(sequence(1, k % 4), i -> map('action_id', 'act', 'item', concat('sku', i), "
        "'ts', cast(unix_millis(cast(ts as timestamp)) + i as string))) as actions",
        "if(event_type = 'error', concat('{\"error_code\":', k, '}'), null) as err",
        "unix_millis(cast(ts as timestamp)) as ts",
        "event_id",
        "k",
    ).withColumns(
        {
            # sequence(1, 0) would count down
            "displays": F.expr("if(k % 3 = 0, cast(null as array<map<string,string>>), displays)"),
            "actions": F.expr("if(k % 4 = 0, cast(null as array<map<string,string>>), actions)"),
        }
    ).drop("k")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as page records."""
    return log_of(table(spark, sf_dir, "events")).select("common", "page", "ts", "event_id")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as JSON text; every 97th line is broken."""
    rows = log_of(table(spark, sf_dir, "events"))
    text = F.to_json(F.struct(*schemas.LOG.names))
    broken = F.concat(F.lit('{"broken":'), F.col("event_id").cast("string"))
    return rows.select(F.when(F.col("event_id") % 97 == 0, broken).otherwise(text).alias("value"))


# --- row changes -----------------------------------------------------------
def _moment(day: str, secs: str) -> str:
    days = f"datediff(cast({day} as date), date'1995-01-01') % 30"
    return f"timestampadd(SECOND, {days} * 86400 + ({secs}), {_START})"


def _text(moment: str) -> str:
    return f"date_format({moment}, 'yyyy-MM-dd HH:mm:ss')"


def _epoch(moment: str) -> str:
    return f"cast(unix_seconds(cast({moment} as timestamp)) as string)"


def _dec(x: str) -> str:
    return f"cast(cast({x} as decimal(18,2)) as string)"


def _row(**columns: str) -> dict[str, str]:
    """Column -> expression; in a change all values are text."""
    return {k: f"cast({v} as string)" for k, v in columns.items()}


_NO_OLD = "cast(null as map<string,string>)"
_ORDER_AT = _moment("o_orderdate", "(o_orderkey * 37) % 86400")
_LINE_AT = _moment("l_shipdate", "(l_orderkey * 37 + l_linenumber * 11) % 86400")
# Columns worked out once per source row and used by several change values.
_PREPARED = {
    "orders": [("made", _ORDER_AT), ("later", "timestampadd(SECOND, 600 + o_orderkey % 3600, made)")],
    "lineitem": [
        ("made", _LINE_AT),
        ("later", "timestampadd(SECOND, 900 + l_orderkey % 3600, made)"),
        ("line", "concat(l_orderkey, '-', l_linenumber)"),
    ],
    "events": [("k", _K)],
    "customer": [("made", f"timestampadd(SECOND, (c_custkey * 977) % 2592000, {_START})")],
}


def _order(status: str, operate: str = "null") -> dict[str, str]:
    return _row(
        id="o_orderkey",
        consignee="concat('user', o_custkey)",
        total_amount=_dec("o_totalprice"),
        order_status=status,
        user_id="o_custkey",
        create_time=_text("made"),
        operate_time=operate,
        province_id="o_custkey % 26",
        original_total_amount=_dec("o_totalprice"),
        order_comment="o_orderpriority",
    )


# table -> list of (source table, filter, type, data, old, change time)
_CHANGES: dict[str, list[tuple[str, str, str, dict[str, str], str, str]]] = {
    "order_info": [
        ("orders", "true", "insert", _order("'1001'"), _NO_OLD, "made"),
        (
            "orders",
            "true",
            "update",
            _order("case o_orderstatus when 'F' then '1003' when 'P' then '1005' else '1002' end", _text("later")),
            "map('order_status', '1001')",
            "later",
        ),
        (
            "orders",
            "o_orderstatus = 'P' and o_orderkey % 2 = 0",
            "update",
            _order("'1006'", _text("later")),
            "map('order_status', '1005')",
            "timestampadd(SECOND, 60, later)",
        ),
    ],
    "order_detail": [
        (
            "lineitem",
            "true",
            "insert",
            _row(
                id="line",
                order_id="l_orderkey",
                sku_id="l_partkey",
                sku_name="concat('sku ', l_partkey)",
                order_price=_dec("l_extendedprice"),
                sku_num="cast(l_quantity as int)",
                create_time=_text("made"),
                source_type="1 + l_partkey % 5",
                source_id="l_suppkey",
                split_total_amount=_dec("l_extendedprice"),
                split_activity_amount="if(l_discount > 0.05, cast(round(l_discount * 100) as int), null)",
                split_coupon_amount="if(l_tax > 0.04, cast(round(l_tax * 100) as int), null)",
            ),
            _NO_OLD,
            "made",
        )
    ],
    "order_detail_activity": [
        (
            "lineitem",
            "l_discount > 0.05",
            "insert",
            _row(
                id="concat('a', line)",
                order_id="l_orderkey",
                order_detail_id="line",
                activity_id="l_partkey % 10",
                activity_rule_id="l_partkey % 4",
                sku_id="l_partkey",
                create_time=_text("made"),
            ),
            _NO_OLD,
            "made",
        )
    ],
    "order_detail_coupon": [
        (
            "lineitem",
            "l_tax > 0.04",
            "insert",
            _row(
                id="concat('c', line)",
                order_id="l_orderkey",
                order_detail_id="line",
                coupon_id="l_suppkey % 8",
                coupon_use_id="l_suppkey",
                sku_id="l_partkey",
                create_time=_text("made"),
            ),
            _NO_OLD,
            "made",
        )
    ],
    "payment_info": [
        (
            "orders",
            "o_orderstatus = 'O'",
            "update",
            _row(
                id="o_orderkey",
                user_id="o_custkey",
                order_id="o_orderkey",
                payment_type="1 + o_orderkey % 5",
                callback_time=_text("later"),
                payment_status="if(o_orderkey % 9 = 0, '1601', '1602')",
            ),
            "map('payment_status', '1601')",
            "later",
        )
    ],
    "order_refund_info": [
        (
            "lineitem",
            "l_returnflag = 'R'",
            "insert",
            _row(
                id="concat('r', line, '-', l_partkey, '-', l_suppkey)",
                user_id="l_orderkey % 1000",
                order_id="l_orderkey",
                sku_id="l_partkey",
                refund_type="1 + l_linenumber % 5",
                refund_num="cast(l_quantity as int)",
                refund_amount=_dec("l_extendedprice"),
                refund_reason_type="1 + l_partkey % 5",
                refund_reason_txt="l_linestatus",
                create_time=_text("later"),
            ),
            _NO_OLD,
            "later",
        )
    ],
    "refund_payment": [
        (
            "lineitem",
            "l_returnflag = 'R' and l_suppkey % 2 = 0",
            "update",
            _row(
                id="concat('p', line, '-', l_partkey, '-', l_suppkey)",
                order_id="l_orderkey",
                sku_id="l_partkey",
                payment_type="1 + l_suppkey % 5",
                callback_time=_text("timestampadd(SECOND, 120, later)"),
                total_amount=_dec("l_extendedprice"),
                refund_status="if(l_linenumber % 2 = 0, '0702', '0701')",
            ),
            "map('refund_status', '0701')",
            "timestampadd(SECOND, 120, later)",
        )
    ],
    "cart_info": [
        (
            "events",
            "event_type in ('click', 'purchase')",
            "if(event_type = 'click', 'insert', 'update')",
            _row(
                id="event_id",
                user_id="user_id",
                sku_id="k",
                cart_price=_dec("value"),
                sku_num="k % 5 + 1",
                sku_name=f"concat('sku ', k)",
                create_time="date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
                operate_time="if(event_type = 'purchase', date_format(timestampadd(SECOND, 30, ts), 'yyyy-MM-dd HH:mm:ss'), null)",
                source_type=f"1 + k % 5",
                source_id="event_id % 10",
            ),
            f"if(event_type = 'purchase', map('sku_num', if(k % 7 = 0, null, cast(user_id % 6 as string))), {_NO_OLD})",
            "ts",
        )
    ],
    "coupon_use": [
        (
            "events",
            "event_type in ('view', 'signup', 'error')",
            "if(event_type = 'view', 'insert', 'update')",
            _row(
                id="event_id",
                coupon_id=f"k % 8",
                user_id="user_id",
                order_id="event_id % 1000",
                get_time="if(event_type = 'view', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), null)",
                using_time="if(event_type = 'signup', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), null)",
                used_time="if(event_type = 'error', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), null)",
                coupon_status="case event_type when 'view' then '1401' when 'signup' then '1402' else '1403' end",
            ),
            f"case when event_type = 'view' then {_NO_OLD} "
            f"when event_id % 3 = 0 then map('used_time', null, 'coupon_status', '1402') "
            f"else map('coupon_status', '1401') end",
            "ts",
        )
    ],
    "favor_info": [
        (
            "events",
            "event_type in ('view', 'click')",
            "if(event_type = 'view', 'insert', 'update')",
            _row(
                id="event_id",
                user_id="user_id",
                sku_id="k",
                create_time="date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
                is_cancel=f"k % 2",
            ),
            _NO_OLD,
            "ts",
        )
    ],
    "comment_info": [
        (
            "events",
            "event_type = 'purchase'",
            "insert",
            _row(
                id="event_id",
                user_id="user_id",
                sku_id="k",
                order_id="event_id % 1000",
                create_time="date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
                appraise=f"1 + k % 5",
            ),
            _NO_OLD,
            "ts",
        )
    ],
    "user_info": [
        (
            "customer",
            "true",
            "insert",
            _row(
                id="c_custkey",
                create_time=_text("made"),
            ),
            _NO_OLD,
            "made",
        )
    ],
    "sku_info": [
        (
            "part",
            "true",
            "bootstrap-insert",
            _row(
                id="p_partkey",
                spu_id="p_partkey % 50",
                tm_id="substring_index(p_brand, '#', -1)",
                category3_id="p_partkey % 25",
                sku_name="p_name",
                sku_desc="p_type",
            ),
            _NO_OLD,
            _START,
        ),
        (
            "part",
            "p_size > 40",
            "update",
            _row(
                id="p_partkey",
                spu_id="p_partkey % 50",
                tm_id="substring_index(p_brand, '#', -1)",
                category3_id="p_partkey % 25",
                sku_name="concat(p_name, ' new')",
                sku_desc="p_type",
            ),
            "map('sku_name', p_name)",
            f"timestampadd(SECOND, p_size, {_START})",
        ),
    ],
    "spu_info": [
        (
            "part: p_partkey % 50 as spu",
            "true",
            "insert",
            _row(id="spu", spu_name="concat('spu ', spu)"),
            _NO_OLD,
            _START,
        )
    ],
    "base_trademark": [
        (
            "part",
            "true",
            "insert",
            _row(id="substring_index(p_brand, '#', -1)", tm_name="p_brand"),
            _NO_OLD,
            _START,
        )
    ],
    "base_category3": [
        (
            "nation",
            "true",
            "insert",
            _row(id="n_nationkey", name="concat('c3 ', n_name)", category2_id="n_regionkey"),
            _NO_OLD,
            _START,
        )
    ],
    "base_category2": [
        (
            "region",
            "true",
            "insert",
            _row(id="r_regionkey", name="concat('c2 ', r_name)", category1_id="r_regionkey % 2"),
            _NO_OLD,
            _START,
        )
    ],
    "base_category1": [
        (
            "region: r_regionkey % 2 as category1",
            "true",
            "insert",
            _row(id="category1", name="concat('c1 ', category1)"),
            _NO_OLD,
            _START,
        )
    ],
    "base_province": [
        ("nation", "true", "insert", _row(id="n_nationkey", name="n_name"), _NO_OLD, _START)
    ],
}

SHOP = "shop"
DIMENSION_TABLES = (
    "sku_info spu_info base_trademark base_category3 base_category2 base_category1 base_province".split()
)


def _source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """A table, or `table: expression`, its distinct values over all rows."""
    name, _, values = source.partition(": ")
    rows = table(spark, sf_dir, name)
    return rows.selectExpr(values).distinct() if values else rows


#: Columns that the facts of a table read, also those that the given tables have nothing for.
_READ = {"order_info": schemas.ORDER_INFO_KEYS, "order_detail": schemas.ORDER_DETAIL_KEYS, "cart_info": schemas.CART_KEYS}


@lru_cache(maxsize=512)
def _changes_of(spark: SparkSession, sf_dir: str, name: str, typed: bool) -> DataFrame:
    """`typed`: the row's columns lie side by side under the alias `data`, of which Spark makes and reads only those in use."""
    parts = []
    for source, rule, kind, data, old, when in _CHANGES[name]:
        kind = kind if kind.startswith("if") else f"'{kind}'"
        rows = _source(spark, sf_dir, source).where(rule)
        for column, made_as in _PREPARED.get(source, []):
            rows = rows.withColumn(column, F.expr(made_as))
        values = {**dict.fromkeys(_READ.get(name, ()) if typed else (), "cast(null as string)"), **data}
        inner = ", ".join(f"'{k}', {v}" for k, v in values.items())
        parts.append(
            rows.selectExpr(
                f"'{SHOP}' as database",
                f"'{name}' as table",
                f"{kind} as type",
                f"{_epoch(when)} as ts",
                *([f"{v} as {k}" for k, v in values.items()] if typed else [f"map({inner}) as data"]),
                f"{old} as old",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def changes(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """Row-change records of the named tables (all by default) as one feed; a row is a map, as tables differ."""
    return reduce(DataFrame.unionByName, [_changes_of(spark, sf_dir, n, False) for n in tables or _CHANGES])


def feeds(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    """The same records, one typed feed per table."""
    return {n: _changes_of(spark, sf_dir, n, True).alias("data") for n in tables}


def change_lines(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """The same records as JSON text."""
    rows = changes(spark, sf_dir, *tables)
    return rows.select(F.to_json(F.struct(*schemas.CHANGE.names)).alias("value"))


# --- dictionary, configuration, dimensions ---------------------------------
def _stored(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Write a look-up table once and read it back, as the dimension job leaves it.

    Planning then knows its true size: a small one is broadcast, a large one is
    shuffled.  Derived in place from the fact tables, its size would be guessed
    from theirs, and the facts shuffled by a key of a few values.
    """
    path = work_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@lru_cache(maxsize=64)
def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes 1, 2, 3, 5 from the order priorities; code 4 stays unknown."""
    priorities = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    rows = priorities.selectExpr(
        "substring(o_orderpriority, 1, 1) as dic_code",
        "substring(o_orderpriority, 3) as dic_name",
        "cast(null as string) as parent_code",
        "cast(null as timestamp) as create_time",
        "cast(null as timestamp) as operate_time",
    )
    return _stored(spark, "base_dic", rows.where("dic_code <> '4'"))


# source table, sink table, kept columns, key, extra clause
ROUTES = [
    ("sku_info", "dim_sku_info", "id, spu_id,tm_id,category3_id,sku_name", "id", None),
    ("spu_info", "dim_spu_info", "id,spu_name", None, None),
    ("base_trademark", "dim_base_trademark", "id,tm_name", "", None),
    ("base_category3", "dim_base_category3", "id,name,category2_id", "id", None),
    ("base_category2", "dim_base_category2", "id,name,category1_id", "id", None),
    ("base_category1", "dim_base_category1", "id,name", "id", None),
    ("base_province", "dim_base_province", "id,name", "id", None),
]


def routing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROUTES, schemas.ROUTING)


_SHORT = {
    "sku": "sku_info",
    "spu": "spu_info",
    "trademark": "base_trademark",
    "category3": "base_category3",
    "category2": "base_category2",
    "category1": "base_category1",
    "province": "base_province",
}
_COLUMNS = {source: [c.strip() for c in columns.split(",")] for source, _, columns, _, _ in ROUTES}


@lru_cache(maxsize=256)
def _dimension(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    columns = _COLUMNS[source]
    rows = feeds(spark, sf_dir, source)[source].select(
        *[P.new(c).alias(c) for c in columns], F.col("ts").cast("bigint").alias("_at")
    )
    newest = last_per(rows, "id", ["_at", *[c for c in columns if c != "id"]]).drop("_at")
    return _stored(spark, source, newest)


@lru_cache(maxsize=16)
def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = {n: _dimension(spark, sf_dir, _SHORT[n]) for n in ("category1", "category2", "category3")}
    return _stored(spark, "categories", category_tree(levels))


def dimensions(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Dimension tables in their current state, by short name: newest row per key.

    `categories` is the tree of the three category levels, flattened and stored
    as a dimension of its own, so that its size is known when facts are joined.
    """
    made = {short: _dimension(spark, sf_dir, _SHORT[short]) for short in names or _SHORT if short != "categories"}
    return made if names else made | {"categories": _categories(spark, sf_dir)}
