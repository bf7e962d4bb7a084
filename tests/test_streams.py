"""Stream forms over several micro-batches against the forms for tables."""

import random

import pytest
from pyspark.sql import functions as F

from tallyflow import schemas
from tallyflow.functions import predicates as P
from tallyflow.operators import joins as J
from tallyflow.operators import keyed as B
from tallyflow.plans import metrics as M
from tallyflow.plans import table_feeds as A
from tallyflow.plans.stream_catalog import _flat
from tallyflow.sources import feeds as S
from tallyflow.sources import sinks as W
from tallyflow.streaming import keyed as K

FAR = "2100"


def run(spark, df, folder, tag):
    """Drain a stream into parquet and read it back."""
    out = str(folder / f"{tag}-out")
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
    W.start(df, write, str(folder / f"{tag}-progress"), available_now=True).awaitTermination()
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


def laid_down(spark, df, order, folder, parts=3):
    """Rows of a table in `parts` files, in order between files and mixed inside."""
    rows = [tuple(r) for r in df.orderBy(order).collect()]
    size = -(-len(rows) // parts)
    path = str(folder)
    for i in range(parts):
        chunk = rows[i * size : (i + 1) * size]
        random.Random(i).shuffle(chunk)
        spark.createDataFrame(chunk, df.schema).coalesce(1).write.mode("append").parquet(path)
    return S.table_stream(spark, path, df.schema, files_per_batch=1)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    closing = spark.sql(
        "select cast(-1 as bigint) as event_id, timestamp_ntz'2100-01-01 00:00:00' as ts, cast(-1 as bigint) as user_id, "
        "'view' as event_type, 0.0D as value, '{\"k\": 0}' as props"
    )
    return A.table(spark, sf_dir, "events").unionByName(closing)


@pytest.fixture
def page_stream(spark, events, tmp_path):
    stream = laid_down(spark, events, "ts", tmp_path / "events")
    return A.log_of(stream).select("common", "page", "ts", "event_id")


def id_set(df):
    return sorted(r["event_id"] for r in df.where("event_id >= 0").select("event_id").collect())


def test_bounce_over_batches(spark, sf_dir, page_stream, tmp_path):
    flat = _flat(page_stream).select("event_id", "mid", "entry", "rt")
    got = run(spark, K.bounces(flat, "mid", "entry", "rt", "6 hours"), tmp_path, "bounce")
    want = M.user_jumps(A.page_log(spark, sf_dir), 6 * 3600 * 1000)
    assert id_set(got) == id_set(want)


def test_daily_unique_and_flags_over_batches(spark, sf_dir, page_stream, tmp_path):
    got = run(spark, M.unique_visitors(page_stream), tmp_path, "uv")
    assert id_set(got) == id_set(M.unique_visitors(A.page_log(spark, sf_dir)))


def test_new_flag_over_batches(spark, sf_dir, page_stream, tmp_path):
    got = run(spark, K.repair_new_flag(_flat(page_stream), "mid", "rt"), tmp_path, "flag")
    want = B.repair_new_flag(A.page_log(spark, sf_dir))
    got_flags = {r["event_id"]: r["is_new"] for r in got.where("event_id >= 0").collect()}
    assert got_flags == {r["event_id"]: r["common"]["is_new"] for r in want.collect()}


# --- trade metrics on streams ---------------------------------------------
DIMS = {
    "sku": [("s1", "spu1", "t1", "c3"), ("s2", "spu2", "t1", "c3")],
    "spu": [("spu1", "spu one"), ("spu2", "spu two")],
    "trademark": [("t1", "mark")],
    "category3": [("c3", "three", "c2")],
    "category2": [("c2", "two", "c1")],
    "category1": [("c1", "one")],
    "province": [("p1", "north"), ("p2", "south")],
}
DIM_COLUMNS = {
    "sku": "id spu_id tm_id category3_id",
    "spu": "id spu_name",
    "trademark": "id tm_name",
    "category3": "id name category2_id",
    "category2": "id name category1_id",
    "category1": "id name",
    "province": "id name",
}


def dims(spark):
    text = {n: ", ".join(f"{c} string" for c in cols.split()) for n, cols in DIM_COLUMNS.items()}
    return {n: spark.createDataFrame(rows, text[n]) for n, rows in DIMS.items()}


def details(spark):
    """Order lines, some delivered twice, and a far-future one of another user."""
    rng, rows = random.Random(5), []
    for i in range(120):
        minute = i * 7
        when = f"2024-01-{1 + minute // 1440:02d} {minute // 60 % 24:02d}:{minute % 60:02d}:{rng.randrange(60):02d}"
        row = (f"l{i}", f"o{i // 3}", f"u{rng.randrange(5)}", rng.choice(["s1", "s2"]), "2", "3.50", rng.choice(["p1", "p2"]), when, rng.choice([None, "1.00"]), None, "7.00", when)
        rows += [row] * rng.choice([1, 1, 2])
    end = "2100-01-01 00:00:00"
    rows.append(("end", "end", "end", "s1", "1", "1.00", "p1", end, None, None, "1.00", end))
    schema = (
        "id string, order_id string, user_id string, sku_id string, sku_num string, order_price string, province_id string, "
        "create_time string, split_activity_amount string, split_coupon_amount string, split_total_amount string, op string"
    )
    return spark.createDataFrame(rows, schema).withColumn("row_op_ts", F.to_timestamp("op")).drop("op")


def same(got, want, far=FAR):
    got, want = got.where(f"stt < '{far}'"), want.where(f"stt < '{far}'")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert want.count() > 0


@pytest.mark.parametrize("name", ["order", "province_order", "user_spu_order", "payment"])
def test_trade_metric_streams(spark, tmp_path, name):
    table = details(spark)
    if name == "payment":
        table = table.withColumnsRenamed({"id": "order_detail_id", "create_time": "callback_time"})
    time = "callback_time" if name == "payment" else "create_time"
    stream = laid_down(spark, table, [time], tmp_path / "lines")
    job = getattr(M, name)
    args = (dims(spark),) if name in ("province_order", "user_spu_order") else ()
    once = {}
    if name in ("payment", "province_order"):
        with pytest.raises(ValueError, match="own query"):
            job(stream, *args)
        key = "order_detail_id" if name == "payment" else "id"
        newest = K.last_wins(stream.withColumn("rt", F.to_timestamp(time)), key, "row_op_ts", "rt")
        kept = run(spark, newest, tmp_path, "newest").drop("rt")
        assert kept.count() == table.select(key).distinct().count() - 1  # the closing row is still held
        closing = table.where(f"{time} like '{FAR}%'")
        stream = laid_down(spark, kept.unionByName(closing), [time], tmp_path / "newest")
        once = {"deduplicated": True}
    got = run(spark, job(stream, *args, length="1 hour", **once), tmp_path, name)
    same(got, job(table, *args, length="1 hour"))


def test_left_stream_join_closes_with_time(spark, tmp_path):
    left = spark.sql("select id as l, timestamp_seconds(1704067200 + id * 10) as lt from range(20) union all select 99, timestamp'2100-01-01'")
    right = spark.sql("select id as r, timestamp_seconds(1704067200 + id * 10 + 3) as rt from range(0, 20, 2) union all select 98, timestamp'2100-01-01'")
    l_stream = laid_down(spark, left, "l", tmp_path / "left")
    r_stream = laid_down(spark, right, "r", tmp_path / "right")
    joined = J.stream_join(l_stream, r_stream, F.expr("l = r"), "lt", "rt", "5 seconds", "5 seconds", "left")
    got = run(spark, joined, tmp_path, "left")
    assert sorted((r["l"], r["r"]) for r in got.where("l < 90").collect()) == [
        (i, i if i % 2 == 0 else None) for i in range(20)
    ]


def test_traffic_metric_stream(spark, events, tmp_path):
    """Three topics in one aggregate, with the longer delay."""
    pages = laid_down(spark, A.log_of(events).select("common", "page", "ts", "event_id"), "ts", tmp_path / "pages")
    entries = pages.where(P.entry_page())
    got = run(spark, M.traffic(pages, entries, entries, "1 hour"), tmp_path, "traffic")
    table = A.log_of(events).select("common", "page", "ts", "event_id")
    opened = table.where(P.entry_page())
    want = M.traffic(table, opened, opened, "1 hour")
    assert want.columns == schemas.METRICS["traffic"]
    same(got, want)


def test_new_flag_over_several_arrow_batches(spark, tmp_path):
    """A visitor's rows of one micro-batch come in chunks; the earliest row of all of them tells the first day."""
    rows = [(5, "m", "1", 2 * 86_400_000 + i) for i in range(3)] + [(1, "m", "1", 1000), (2, "m", "1", 2000)]
    spark.createDataFrame(rows, "event_id long, mid string, is_new string, ts long").coalesce(1).write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        flat = S.table_stream(spark, str(tmp_path / "in")).withColumn("rt", F.timestamp_millis("ts"))
        got = []
        query = W.start(
            K.repair_new_flag(flat, "mid", "rt"), lambda b, _: got.extend(b.collect()), str(tmp_path / "p"), available_now=True
        )
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.ts, r.is_new) for r in got) == [(1000, "1"), (2000, "1")] + [(2 * 86_400_000 + i, "0") for i in range(3)]


def test_last_arrival_wins_among_equal_times(spark, tmp_path):
    path = str(tmp_path / "dims")
    routing = spark.createDataFrame([("t", "dim_t", "id,name", "id", None)], schemas.ROUTING)
    write = W.dimension_writer(path, lambda _: routing)
    change = lambda name: ("shop", "t", "update", "100", {"id": "1", "name": name}, None)
    write(spark.createDataFrame([change("zzz old"), change("zz older")][::-1], schemas.CHANGE), 0)
    write(spark.createDataFrame([change("aaa new")], schemas.CHANGE), 1)
    now = S.current_dimensions(spark, path, "dim_t", ["id", "name"])
    assert [tuple(r) for r in now.collect()] == [("1", "aaa new")]


def test_lookup_rows_added_while_the_stream_runs(spark, tmp_path):
    codes, out = str(tmp_path / "dic"), str(tmp_path / "out")
    add = lambda code: spark.createDataFrame([(code, f"name {code}", None, None, None)], schemas.DICTIONARY).write.mode("append").parquet(codes)
    add("1")
    writer = W.enriched(
        lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"),
        lambda b: J.with_dictionary(b, S.dictionary_table(spark, codes), "code", "dic_name"),
    )
    rows = spark.createDataFrame([("1",), ("2",)], "code string")
    writer(rows, 0)
    add("2")
    writer(rows, 1)
    got = sorted((r.code, r.batch) for r in spark.read.parquet(out).collect())
    assert got == [("1", 0), ("1", 1), ("2", 1)]
