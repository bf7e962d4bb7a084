"""Stream forms of the operators as queries.

Each query runs the real stream over the given table until it is used up, into
a work folder, and returns what was written.  A time-bounded operator only lets
go of its last rows when time moves on, so one far-future record of its own key
closes every input; it is left out of the results.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import predicates as P
from ..functions.timefmt import at, day_text, leading_day
from ..operators import dims as D
from ..operators import facts as X
from ..operators import joins as J
from ..operators import logsplit as L
from ..operators.parse import clean_rows
from ..operators.windows import window_sums
from ..session import JOIN_STATE, STATE_PROVIDER, work_folder
from ..sources import feeds as S
from ..sources import sinks as W
from ..streaming import keyed as K
from . import metrics as M
from . import table_feeds as A
from .catalog import BACK_DAYS, HOUR, QUERIES, _shown, query

_END_ID, _END_DAY = -1, "2100-01-01"
#: The closing record's own window, and no other.
_NOT_CLOSING = f"stt <> '{_END_DAY} 00:00:00'"


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a stream, closed by one far-future record."""
    spark.conf.set(*STATE_PROVIDER)
    # A pattern, as a stream's plain path must be a folder and a table may be one file.
    path = f"{sf_dir}/events.parquet*"
    schema = A.table(spark, sf_dir, "events").schema
    folder = work_folder(spark, "closing")
    closing = spark.range(1).selectExpr(
        f"cast({_END_ID} as bigint) as event_id",
        f"timestamp_ntz'{_END_DAY} 00:00:00' as ts",
        f"cast({_END_ID} as bigint) as user_id",
        "'view' as event_type",
        "0.0D as value",
        """'{"k": 0}' as props""",
    )
    closing.select(*schema.names).write.parquet(folder)
    return S.table_stream(spark, path, schema).unionByName(S.table_stream(spark, folder, schema))


def _pages(spark, sf_dir) -> DataFrame:
    return A.log_of(_events_stream(spark, sf_dir)).select("common", "page", "ts", "event_id")


def _flat(pages: DataFrame) -> DataFrame:
    return pages.select(
        "event_id",
        F.col("common.mid").alias("mid"),
        F.col("common.is_new").alias("is_new"),
        P.entry_page().alias("entry"),
        day_text(at("ts")).alias("day"),
        at("ts").alias("rt"),
    )


def _finish(query_) -> None:
    query_.awaitTermination()


def _drain(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run a stream to its end and read what it wrote."""
    out = work_folder(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _finish(W.start(df, write, work_folder(spark, f"{name}-progress"), available_now=True))
    return spark.read.schema(df.schema).option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


@query
def stream_window(spark, sf_dir):
    """Ten-second window sums."""
    events = _events_stream(spark, sf_dir)
    rows = events.select(F.col("ts").cast("timestamp").alias("rt"), "event_type", "value", "event_id")
    sums = {"n": F.lit(1).cast("bigint"), "total": F.col("value").cast("decimal(18,2)")}
    out = _drain(spark, window_sums(rows, "rt", sums, ("event_type",)), "window")
    return out.where(_NOT_CLOSING).withColumn("total", F.round(F.col("total").cast("double"), 2))


@query
def stream_daily_unique(spark, sf_dir):
    entries = _flat(_pages(spark, sf_dir)).where("entry")
    out = _drain(spark, K.day_firsts(entries, "mid", "day", "rt"), "daily-unique")
    return out.where(f"event_id <> {_END_ID}").select("event_id", "mid")


@query
def stream_new_flag(spark, sf_dir):
    out = _drain(spark, K.repair_new_flag(_flat(_pages(spark, sf_dir)), "mid", "rt"), "new-flag")
    return out.where(f"event_id <> {_END_ID}").select("event_id", "mid", "is_new")


@query
def stream_bounce(spark, sf_dir):
    rows = _flat(_pages(spark, sf_dir)).select("event_id", "mid", "entry", "rt")
    out = _drain(spark, K.bounces(rows, "mid", "entry", "rt", "6 hours"), "bounce")
    return out.where(f"event_id <> {_END_ID}").select("event_id", "mid")


@query
def stream_dedup_first(spark, sf_dir):
    """One row per visitor and day; which of them is left to arrival."""
    rows = _flat(_pages(spark, sf_dir)).select(F.concat_ws("|", "mid", "day").alias("id"), "rt")
    out = _drain(spark, K.first_wins(rows, "id", "rt", "2 days"), "dedup-first")
    return out.where(f"id <> '{_END_ID}|{_END_DAY}'").select("id")


@query
def stream_dedup_last(spark, sf_dir):
    rows = _flat(_pages(spark, sf_dir)).select(F.concat_ws("|", "mid", "day").alias("id"), "event_id", "rt")
    out = _drain(spark, K.last_wins(rows, "id", "event_id", "rt", "2 days"), "dedup-last")
    return out.where(f"event_id <> {_END_ID}").select("id", "event_id")


@query
def stream_interval_join(spark, sf_dir):
    events = _events_stream(spark, sf_dir)

    def side(kind: str, tag: str) -> DataFrame:
        rows = events.where(F.col("event_type") == kind)
        return rows.select(
            F.col("user_id").alias(f"{tag}_user"),
            F.col("event_id").alias(f"{tag}_id"),
            F.col("ts").cast("timestamp").alias(f"{tag}_ts"),
        )

    same = F.expr("click_user = buy_user")
    pairs = J.stream_join(side("click", "click"), side("purchase", "buy"), same, "click_ts", "buy_ts", HOUR, HOUR)
    out = _drain(spark, pairs, "interval-join")
    return out.select(F.col("click_user").alias("user_id"), "click_id", "buy_id")


@query
def stream_lookup_join(spark, sf_dir):
    """Stream rows against the dictionary table."""
    rows = _events_stream(spark, sf_dir).select(
        "event_id", F.col("user_id").cast("string").alias("user"), "value"
    )
    out = _drain(spark, J.with_dictionary(rows, A.dictionary(spark, sf_dir), "user", "dic_name"), "lookup-join")
    return out.where(f"event_id <> {_END_ID}")


@query
def stream_login(spark, sf_dir):
    """Keyed state, then windows, then the metric sink."""
    out, name = work_folder(spark, "login"), "login"
    metric = M.login(_pages(spark, sf_dir), HOUR, BACK_DAYS)
    writer = W.metric_writer(out, schemas.METRICS[name])
    _finish(W.start(metric, writer, work_folder(spark, "login-progress"), available_now=True))
    return S.metric_table(spark, out).select(*schemas.METRICS[name]).where(_NOT_CLOSING)


@query
def stream_page_uv(spark, sf_dir):
    out = _drain(spark, M.page_view(_pages(spark, sf_dir), HOUR), "page-uv")
    return out.where(_NOT_CLOSING)


@query
def stream_keyword(spark, sf_dir):
    # The closing record is no search; any record moves time on.
    pages = _pages(spark, sf_dir)
    closing = F.col("event_id") == _END_ID
    page = F.col("page")
    searched = F.when(
        closing, page.withField("last_page_id", F.lit("search")).withField("item_type", F.lit("keyword"))
    ).otherwise(page)
    out = _drain(spark, M.keyword(pages.withColumn("page", searched), HOUR), "keyword")
    return out.where(_NOT_CLOSING)


@query
def stream_upsert(spark, sf_dir):
    """Newest event per user through the upsert sink."""
    rows = _events_stream(spark, sf_dir).select("user_id", "event_id", "event_type")
    out = work_folder(spark, "upsert")
    writer = W.upsert_writer(out, ["user_id"], ["event_id"])
    _finish(W.start(rows, writer, work_folder(spark, "upsert-progress"), available_now=True))
    latest = W.read_upserts(spark, out, ["user_id"], ["event_id"])
    return latest.where(f"user_id <> {_END_ID}")


def _text_stream(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """A feed's text lines, laid down in a folder and streamed from it."""
    folder = work_folder(spark, name)
    lines.write.text(folder)
    return S.folder_lines(spark, folder)


@query
def stream_log_fan_out(spark, sf_dir):
    """Text lines parsed once and written to five targets; rows per target."""
    logs = S.log_rows(_text_stream(spark, A.raw_log(spark, sf_dir), "log"))
    out = work_folder(spark, "fan-out")
    writer = W.fan_out(L.split_log, out)
    _finish(W.start(logs, writer, work_folder(spark, "fan-out-progress"), available_now=True))
    written = spark.read.text(f"{out}/*/batch=*").select(
        F.regexp_extract(F.input_file_name(), r"/([a-z]+)/batch=", 1).alias("target")
    )
    return written.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_coupon_order(spark, sf_dir):
    """A fact straight from change text, appended as JSON lines."""
    lines = _text_stream(spark, A.change_lines(spark, sf_dir, "coupon_use"), "changes")
    facts = X.coupons_ordered(S.change_rows(lines))
    out = work_folder(spark, "coupon-order")
    _finish(W.append_files(facts, out, work_folder(spark, "coupon-order-progress"), available_now=True))
    return clean_rows(spark.read.text(out), facts.schema)


@query
def stream_dimensions(spark, sf_dir):
    """Dimension changes routed and upserted batch by batch; the newest rows."""
    lines = _text_stream(spark, A.change_lines(spark, sf_dir, *A.DIMENSION_TABLES), "dim-changes")
    out = work_folder(spark, "dimensions")
    writer = W.dimension_writer(out, A.routing)
    _finish(W.start(S.change_rows(lines), writer, work_folder(spark, "dim-progress"), available_now=True))
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    name = F.coalesce(*[P.new(c) for c in ("sku_name", "spu_name", "tm_name", "name")])
    return D.latest_dimensions(rows).select("sink_table", "pk", name.alias("name"))


# --- trade facts -----------------------------------------------------------
#: The given tables' changes lie anywhere in one month.
_MONTH = "31 days"
_SLICES = ["ts < '1704931200'", "ts >= '1704931200' and ts < '1705795200'", "ts >= '1705795200'"]
#: Rounds of closing records: a row that one bounded join lets go waits in the next one for time to move on again.
#: All changes lie in January 2024; the first round comes on the fifth of February.
_CLOSING_ROUNDS, _CLOSING_AT = 4, 1707091200


def _closing_change(table: str, key: str, at_second: int) -> str:
    """A change record after all others, whose keys no other record has; it lets waiting rows go."""
    columns = dict.fromkeys("id order_id order_detail_id sku_id user_id".split(), key)
    columns |= {"order_info": {"order_status": "1001"}, "payment_info": {"payment_status": "1602"}}.get(table, {})
    kind = "update" if table == "payment_info" else "insert"
    return json.dumps({"database": A.SHOP, "table": table, "type": kind, "ts": str(at_second), "data": columns, "old": None})


def _closing_keys(spark: SparkSession, turn: int) -> list[str]:
    return [f"closing-{turn}-{i}" for i in range(spark.sparkContext.defaultParallelism)]


def _without_closing(rows: DataFrame, key: str) -> DataFrame:
    spark = rows.sparkSession
    return rows.where(~F.col(key).isin([k for turn in range(_CLOSING_ROUNDS) for k in _closing_keys(spark, turn)]))


def _lay_down(lines: DataFrame, folder: str, parts: int) -> None:
    """Add text lines to a folder as `parts` compressed files, the files of one micro-batch.

    Where the rows are read in as many parts, nothing is shuffled; parts without a
    row leave no file, and a file with an empty line, which no reader takes for a
    record, stands for each.
    """
    spark = lines.sparkSession
    if lines.rdd.getNumPartitions() < parts:
        lines.repartition(parts).write.mode("append").option("compression", "gzip").text(folder)
        return
    before = len(_files(spark, folder))
    lines.coalesce(parts).write.mode("append").option("compression", "gzip").text(folder)
    missing = parts - (len(_files(spark, folder)) - before)
    if missing:
        spark.range(0, missing, 1, missing).selectExpr("'' as value").write.mode("append").option("compression", "gzip").text(folder)


def _files(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    return spark.read.text(folder).inputFiles()


def _change_stream(
    spark: SparkSession, sf_dir: str, name: str, when: str = "ts", slices: list[str] = _SLICES, rounds: int = _CLOSING_ROUNDS
) -> DataFrame:
    """A table's changes as text in order of time, several micro-batches of files, and rounds of closing records.

    `when` is the second a change is told to have happened at.
    """
    spark.conf.set(*STATE_PROVIDER)
    folder, parts = work_folder(spark, f"changes-{name}"), spark.sparkContext.defaultParallelism
    told = A.changes(spark, sf_dir, name).withColumn("ts", F.expr(when).cast("string"))
    for rule in slices:
        rows = told.where(rule).select(F.to_json(F.struct(*schemas.CHANGE.names)).alias("value"))
        _lay_down(rows, folder, parts)
    for turn in range(rounds):
        # One record in each of as many files as a micro-batch takes, so that rounds do not share one.
        text = _closing_change(name, f"closing-{turn}-#", _CLOSING_AT + 60 * turn)
        last = spark.range(0, parts, 1, parts).select(F.replace(F.lit(text), F.lit("#"), F.col("id").cast("string")).alias("value"))
        last.write.mode("append").text(folder)
    return S.change_rows(S.folder_lines(spark, folder, files_per_batch=parts))


def _refund_feeds(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    """An inner join gives out a pair when its second row comes; nothing waits for closing records, and each round would read all state."""
    return {t: _change_stream(spark, sf_dir, t, rounds=0) for t in tables}


def _upserted(spark: SparkSession, df: DataFrame, name: str, keys: list[str], order: list[str]) -> DataFrame:
    """Run a fact to its end through the upsert sink; the rows it then holds."""
    out = work_folder(spark, name)
    progress = work_folder(spark, f"{name}-progress")
    _finish(W.start(df, W.upsert_writer(out, keys, order), progress, available_now=True, conf=JOIN_STATE))
    return W.read_upserts(spark, out, keys, order).select(*df.columns)


@query
def stream_refund_detail(spark, sf_dir):
    feeds = _refund_feeds(spark, sf_dir, "order_info", "order_refund_info")
    rows = X.stream_refund_requests(feeds, A.dictionary(spark, sf_dir), within=_MONTH)
    return _shown(_upserted(spark, rows, "refund-detail", ["id"], ["row_op_ts"]))


@query
def stream_refund_paid(spark, sf_dir):
    feeds = _refund_feeds(spark, sf_dir, "order_info", "order_refund_info", "refund_payment")
    rows = X.stream_refunds_paid(feeds, A.dictionary(spark, sf_dir), within=_MONTH)
    return _shown(_upserted(spark, rows, "refund-paid", ["id", "_request"], ["row_op_ts"]).drop("_request"))


# --- order lines -------------------------------------------------------------
_KEY = "cast(coalesce(data['order_id'], data['id']) as bigint)"
_OPENED = f"1704067200 + ({_KEY} * 37) % 259200"
_NUMBER = "cast(substring_index(coalesce(data['order_detail_id'], data['id']), '-', -1) as int)"
#: Seconds at which an order's changes are told, around the bounds of 5 and 905 seconds: some fall inside, some outside.
_TOLD = {
    "order_info": f"{_OPENED} + case when type = 'insert' then 0 when data['order_status'] = '1006' then 62 + {_KEY} % 5 else 2 + {_KEY} % 5 end",
    "order_detail": f"{_OPENED} + {_NUMBER}",
    "order_detail_activity": f"{_OPENED} + {_NUMBER} + cast(data['sku_id'] as bigint) % 8",
    "order_detail_coupon": f"{_OPENED} + {_NUMBER} - cast(data['coupon_use_id'] as bigint) % 8",
    "payment_info": f"{_OPENED} + 895 + {_KEY} % 16",
}
#: One day each; orders that open at midnight are cut through, so that their state lives over a micro-batch.
_DAYS = ["ts < '1704153600'", "ts >= '1704153600' and ts < '1704240000'", "ts >= '1704240000'"]


def _order_feeds(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    return {t: _change_stream(spark, sf_dir, t, _TOLD[t], _DAYS) for t in tables}


def _wide_lines(spark: SparkSession, sf_dir: str, name: str, shape, versions) -> DataFrame:
    """Order lines from four feeds through the keyed state, as `shape` makes facts of them, appended batch by batch.

    `versions` tells the changes of orders that `shape` keeps; no others are held.
    """
    feeds = _order_feeds(spark, sf_dir, "order_info", "order_detail", "order_detail_activity", "order_detail_coupon")
    facts = shape(X.stream_order_wide(feeds, A.dictionary(spark, sf_dir), versions=versions))
    return _without_closing(_drain(spark, facts, name), "order_id")


@query
def stream_order_detail(spark, sf_dir):
    """Order lines with activity, coupon and order from four streams, within five seconds."""
    return _shown(_wide_lines(spark, sf_dir, "order-detail", X.order_details, X.is_new_order()))


@query
def stream_order_cancel(spark, sf_dir):
    return _wide_lines(spark, sf_dir, "order-cancel", X.cancelled_details, X.is_cancellation(P.new("order_status")))


@query
def stream_pay_detail(spark, sf_dir):
    """Payments met with the lines that the first stream has written, within 905 seconds, in either order of arrival."""
    details = _wide_lines(spark, sf_dir, "paid-lines", X.order_details, X.is_new_order())
    folder, parts = work_folder(spark, "paid-lines-told"), spark.sparkContext.defaultParallelism
    for hour in ("row_op_ts < '2024-01-02'", "row_op_ts >= '2024-01-02' and row_op_ts < '2024-01-03'", "row_op_ts >= '2024-01-03'"):
        details.where(hour).repartition(parts).write.mode("append").parquet(folder)
    lines = S.table_stream(spark, folder, details.schema, files_per_batch=parts)
    feeds = _order_feeds(spark, sf_dir, "payment_info")
    rows = X.stream_paid_details(feeds, lines, A.dictionary(spark, sf_dir))
    return _shown(_drain(spark, rows, "pay-detail").select(*schemas.PAY_DETAIL))


__all__ = ["QUERIES"]
