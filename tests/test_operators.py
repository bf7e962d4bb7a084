"""Parsing, changes, dimensions, joins, tokens and windows, with rows by hand."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyflow import schemas
from tallyflow.functions.tokens import dictionary_words, split_words, words
from tallyflow.operators import dims as D
from tallyflow.operators import facts as X
from tallyflow.operators import joins as J
from tallyflow.operators import logsplit as L
from tallyflow.operators.parse import clean_rows, dirty_lines, strict_rows
from tallyflow.operators.windows import window_distinct, window_sums
from tallyflow.sources import feeds as S
from tallyflow.sources import sinks as W


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


LOG = {
    "common": {"mid": "m1", "is_new": "1", "vc": "v", "ch": "c", "ar": "a", "uid": "u"},
    "page": {"page_id": "home", "during_time": 5},
    "displays": [{"item": "s1", "order": 1}, {"item": "s2", "order": 2}],
    "actions": [{"action_id": "x", "item": "s1", "ts": 7}],
    "err": {"error_code": 3},
    "ts": 1704067200000,
}


# --- parsing ---------------------------------------------------------------
def test_bad_lines_go_to_dirty(spark):
    good = json.dumps(LOG)
    text = lines(spark, good, '{"common":', "", None, "12", "[1]", "plain", '{"ts":"soon"}')
    assert clean_rows(text, schemas.LOG).count() == 1
    dirty = [r["value"] for r in dirty_lines(text, schemas.LOG).collect()]
    assert sorted(dirty) == sorted(['{"common":', "", "", "12", "[1]", "plain", '{"ts":"soon"}'])


def test_strict_parse_fails(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        strict_rows(lines(spark, "{oops"), schemas.LOG).collect()


def test_log_split(spark):
    start = {**LOG, "start": {"entry": "icon"}, "err": None, "page": None}
    parts = L.split_log(clean_rows(lines(spark, json.dumps(LOG), json.dumps(start)), schemas.LOG))
    assert {k: v.count() for k, v in parts.items()} == {
        "page": 1, "start": 1, "display": 2, "action": 1, "error": 1,
    }
    assert "displays" in parts["error"].columns and "displays" not in parts["page"].columns
    assert "err" not in parts["start"].columns
    action = parts["action"].first()
    assert action["ts"] == 7 and json.loads(action["common"])["mid"] == "m1"
    flat = [json.loads(r["value"]) for r in L.as_event(parts["display"], "display").collect()]
    assert {f["item"] for f in flat} == {"s1", "s2"} and all(f["page_id"] == "home" for f in flat)


def test_captured_routing(spark):
    text = lines(spark, '{"op":"c","after":{"sourceTable":"t","sinkTable":"d","sinkColumns":"id,a","sinkPk":"id"}}', '{"after":null}')
    assert [tuple(r) for r in S.captured_routing(text).collect()] == [("t", "d", "id,a", "id", None)]


# --- changes ---------------------------------------------------------------
def changes(spark, rows):
    return spark.createDataFrame(
        [("shop", t, k, "1704067200", d, o) for t, k, d, o in rows],
        "database string, table string, type string, ts string, data map<string,string>, old map<string,string>",
    )


DIC = [("1", "one"), ("2", "two")]


def dic(spark):
    return spark.createDataFrame(DIC, "dic_code string, dic_name string")


def test_cart_delta(spark):
    def row(kind, num, old, source="1", i="1"):
        return ("cart_info", kind, {"id": i, "sku_num": num, "source_type": source}, old)

    feed = changes(
        spark,
        [
            row("insert", "3", None, i="a"),
            row("update", "5", {"sku_num": "2"}, i="b"),
            row("update", "1", {"sku_num": "2"}, i="shrunk"),
            row("update", "5", {"price": "2"}, i="other column"),
            row("update", None, {"sku_num": "2"}, i="null"),
            row("update", "many", {"sku_num": "2"}, i="text"),
            row("insert", "3", None, source="9", i="unknown code"),
        ],
    )
    got = {r["id"]: (r["sku_num"], r["source_type_name"]) for r in X.cart_adds(feed, dic(spark)).collect()}
    assert got == {"a": ("3", "one"), "b": ("3", "one")}
    other = X.cart_adds(feed, dic(spark), database="elsewhere")
    assert other.count() == 0 and other.columns == schemas.CART_ADD


def test_coupon_and_favour_rules(spark):
    feed = changes(
        spark,
        [
            ("coupon_use", "update", {"id": "1", "coupon_status": "1402", "using_time": "2024-01-02 03:04:05"}, {"coupon_status": "1401"}),
            ("coupon_use", "update", {"id": "2", "coupon_status": "1402"}, {"coupon_status": "1400"}),
            ("coupon_use", "update", {"id": "3", "coupon_status": "1403", "used_time": "2024-01-02 03:04:05"}, {"coupon_status": "1402"}),
            ("favor_info", "insert", {"id": "4", "is_cancel": "1"}, None),
            ("favor_info", "update", {"id": "5", "is_cancel": "0"}, None),
            ("favor_info", "update", {"id": "6", "is_cancel": "1"}, None),
        ],
    )
    ordered = X.coupons_ordered(feed).collect()
    assert [(r["id"], r["date_id"], r["order_time"]) for r in ordered] == [("1", "2024-01-02", "2024-01-02 03:04:05")]
    assert [r["id"] for r in X.coupons_paid(feed).collect()] == ["3"]
    assert X.coupons_paid(feed, strict=True).count() == 0
    assert sorted(r["id"] for r in X.favours(feed).collect()) == ["4", "5"]


def order_feed(spark):
    line = {"id": "l1", "order_id": "o1", "sku_id": "s", "sku_num": "2", "order_price": "5.00", "source_type": "1"}
    act = {"id": "x1", "order_detail_id": "l1", "activity_id": "A", "create_time": "2024-01-01 00:00:00"}
    return changes(
        spark,
        [
            ("order_detail", "insert", line, None),
            ("order_detail", "insert", {**line, "id": "l2", "source_type": "9"}, None),
            ("order_info", "insert", {"id": "o1", "order_status": "1001", "user_id": "u"}, None),
            ("order_info", "update", {"id": "o1", "order_status": "1003", "operate_time": "t"}, {"order_status": "1001"}),
            ("order_info", "update", {"id": "o1", "order_status": "1003"}, {"comment": "x"}),
            ("order_detail_activity", "insert", act, None),
            ("order_detail_activity", "insert", {**act, "id": "x2", "activity_id": "B"}, None),
        ],
    )


def test_order_wide(spark):
    wide = X.order_wide(order_feed(spark), dic(spark))
    assert wide.columns == schemas.ORDER_WIDE and len(wide.columns) == 44
    # one row per order version; a replayed activity does not multiply; unknown code lost
    assert wide.count() == 3
    detail = X.order_details(wide).collect()
    assert [(r["id"], r["activity_id"], r["coupon_id"]) for r in detail] == [("l1", "B", None)]
    assert [r["cancel_time"] for r in X.cancelled_details(wide).collect()] == ["t"]


def test_feeds_per_table_equal_one_feed(spark):
    feed = order_feed(spark)
    split = {t: feed.where(F.col("table") == t) for t in "order_detail order_info order_detail_activity order_detail_coupon".split()}
    one, many = X.order_wide(feed, dic(spark)), X.order_wide(split, dic(spark))
    assert one.drop("old").exceptAll(many.drop("old")).count() == 0 and one.count() == many.count()


def test_refund_paid_strict(spark):
    base = {"order_id": "o1", "sku_id": "s"}
    feed = changes(
        spark,
        [
            ("refund_payment", "update", {**base, "id": "p", "payment_type": "2", "refund_status": "0702", "callback_time": "2024-01-02 00:00:00"}, {"refund_status": "0701"}),
            ("refund_payment", "insert", {**base, "id": "q", "payment_type": "2", "callback_time": "2024-01-02 00:00:00"}, None),
            ("order_info", "update", {"id": "o1", "order_status": "1006", "user_id": "u", "province_id": "p1"}, {"order_status": "1005"}),
            ("order_refund_info", "update", {**base, "refund_num": "1", "refund_status": "0705"}, {"refund_status": "0704"}),
        ],
    )
    assert sorted(r["id"] for r in X.refunds_paid(feed, dic(spark)).collect()) == ["p", "q"]
    strict = X.refunds_paid(feed, dic(spark), strict=True).collect()
    assert [(r["id"], r["refund_num"], r["payment_type_name"]) for r in strict] == [("p", "1", "two")]


# --- dimensions ------------------------------------------------------------
def test_route_trims_prunes_and_defaults(spark):
    feed = changes(
        spark,
        [
            ("t", "insert", {"id": "1", "name": "n", "secret": "x"}, None),
            ("t", "delete", {"id": "2"}, None),
            ("unknown", "insert", {"id": "3"}, None),
            ("t", "bootstrap-insert", {"id": "4", "name": "m"}, None),
        ],
    )
    config = spark.createDataFrame([("t", "dim_t", "id, name", None, None)], schemas.ROUTING)
    routed = D.route(feed, config)
    assert sorted((r["pk"], r["sink_table"], tuple(sorted(r["data"]))) for r in routed.collect()) == [
        ("1", "dim_t", ("id", "name")),
        ("4", "dim_t", ("id", "name")),
    ]
    table = D.dimension(D.latest_dimensions(routed), "dim_t", ["id", "name"])
    assert sorted(map(tuple, table.collect())) == [("1", "n"), ("4", "m")]


def test_ensure_table(spark, tmp_path):
    path = str(tmp_path / "dim")
    D.ensure_table(spark, path, "id, name")
    spark.createDataFrame([("1", "n")], "id string, name string").write.mode("append").parquet(path)
    D.ensure_table(spark, path, "id, name")
    assert spark.read.parquet(path).count() == 1
    assert [f.name for f in D.dimension_schema("code,name", "code").fields if not f.nullable] == ["code"]


def test_missing_dimension_key(spark):
    rows = spark.createDataFrame([("1", "p1"), ("2", "p9")], "id string, province_id string")
    dims = {"province": spark.createDataFrame([("p1", "north")], "id string, name string")}
    assert D.with_province(rows, dims).count() == 1
    assert D.with_province(rows, dims, "left").where("province_name is null").count() == 1


# --- joins -----------------------------------------------------------------
def test_interval_join_is_closed(spark):
    left = spark.createDataFrame([("a", "n", 100)], "id string, name string, ts long")
    right = spark.createDataFrame(
        [("a", "x", s) for s in (94, 95, 100, 105, 106)] + [("b", "x", 100)], "id string, sex string, ts2 long"
    )
    pairs = J.interval_join(
        left.withColumn("lt", F.timestamp_seconds("ts")),
        right.withColumn("rt", F.timestamp_seconds("ts2")),
        "id", "lt", "rt",
    )
    assert sorted(r["ts2"] for r in pairs.collect()) == [95, 100, 105]


def test_interval_join_uneven_and_random(spark):
    left = spark.range(300).selectExpr("id as l", "cast(id % 3 as string) as k", "timestamp_seconds(id * 7 % 501) as lt")
    right = spark.range(300).selectExpr("id as r", "cast(id % 3 as string) as k", "timestamp_seconds(id * 11 % 499) as rt")
    got = J.interval_join(left, right, "k", "lt", "rt", "3 seconds", "8 seconds").select("l", "r")
    want = left.join(right, "k").where("rt between lt - interval 3 seconds and lt + interval 8 seconds").select("l", "r")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


# --- words -----------------------------------------------------------------
def test_words(spark):
    df = spark.createDataFrame([(1, "Red SHOES-42, 实时数仓 数"), (2, ""), (3, None)], "id int, t string")
    assert [r["w"] for r in df.select(words("t").alias("w")).collect()] == [
        ["red", "shoes", "42", "实时", "时数", "数仓", "数"], [], None,
    ]
    assert split_words(df, "t").count() == 7


def test_dictionary_words(spark):
    df = spark.createDataFrame([(1, "实时数仓x")], "id int, t string")
    lexicon = spark.createDataFrame([("实时",), ("数仓",), ("实时数仓",)], "word string")
    assert sorted(r["word"] for r in dictionary_words(df, "t", lexicon).collect()) == sorted(
        ["实时", "数仓", "实时数仓", "x"]
    )
    long = spark.createDataFrame([("实时数仓建设指南",)], "word string")
    df8 = spark.createDataFrame([(1, "看实时数仓建设指南")], "id int, t string")
    assert sorted(r["word"] for r in dictionary_words(df8, "t", long).collect()) == sorted(["看", "实时数仓建设指南"])
    few = spark.createDataFrame([("数仓",)], "word string")
    assert sorted(r["word"] for r in dictionary_words(df, "t", few).collect()) == sorted(["实", "时", "数仓", "x"])


def test_dictionary_words_equal_all_substrings(spark):
    """Repeated rows, overlaps, one-letter words, empty texts and an empty lexicon."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab数仓 ") for _ in range(rng.randrange(40))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (90, None), (91, ""), (92, " ")]
    df = spark.createDataFrame(rows, "id int, t string")
    for known in (["a", "AB", "bab", "abab", "数仓", "仓数仓", ""], ["bb"], []):
        lexicon = spark.createDataFrame([(w,) for w in known], "word string")
        words_, want = {w.lower() for w in known} - {""}, []
        for i, t in rows:
            for run in re.findall("[数仓]+|[ab]+", t or ""):
                spans = [(a, b) for a in range(len(run)) for b in range(a + 1, len(run) + 1) if run[a:b] in words_]
                want += [(i, run[a:b]) for a, b in spans]
                want += [(i, c) for n, c in enumerate(run) if not any(a <= n < b for a, b in spans)]
        got = dictionary_words(df, "t", lexicon, script=r"[\p{L}]").select("id", "word").collect()
        assert sorted(map(tuple, got)) == sorted(want)


# --- windows ---------------------------------------------------------------
def test_window_bounds_and_distinct(spark):
    df = spark.createDataFrame(
        [("p", "o1", 0, "1.10"), ("p", "o1", 9, "2.20"), ("p", "o2", 9, "x"), ("p", "o1", 10, "1.00"), ("q", None, 3, "1.00")],
        "province string, order_id string, s long, amt string",
    ).withColumn("rt", F.timestamp_seconds(F.col("s") + 1704067200))
    out = window_distinct(df, "rt", ("province",), "order_id", "n", {"total": F.col("amt").try_cast("decimal(18,2)")})
    rows = {(r["province"], r["stt"]): (r["edt"], r["n"], r["total"] and float(r["total"])) for r in out.collect()}
    assert rows == {
        ("p", "2024-01-01 00:00:00"): ("2024-01-01 00:00:10", 2, 3.3),
        ("p", "2024-01-01 00:00:10"): ("2024-01-01 00:00:20", 1, 1.0),
        ("q", "2024-01-01 00:00:00"): ("2024-01-01 00:00:10", 0, 1.0),
    }
    assert window_sums(df, "rt", {"n": F.lit(1)}).count() == 2


def test_payload_of_empty_records(spark):
    df = spark.createDataFrame([(bytearray(b"x"),), (None,)], "value binary")
    assert [r["value"] for r in S.payload(df).collect()] == ["x", ""]


def test_sinks_can_repeat_a_batch(spark, tmp_path):
    up, metric = str(tmp_path / "up"), str(tmp_path / "metric")
    write = W.upsert_writer(up, ["k"], ["v"])
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    for batch, rows in ((0, first), (0, first), (1, spark.createDataFrame([("b", 5)], "k string, v int"))):
        write(rows, batch)
    assert sorted(map(tuple, W.read_upserts(spark, up, ["k"], ["v"]).collect())) == [("a", 2), ("b", 5)]
    day = spark.createDataFrame([("e", "2024-01-01 00:00:00", 3)], "edt string, stt string, register_ct long")
    sink = W.metric_writer(metric, schemas.METRICS["register"])
    for batch in (0, 0, 1):
        sink(day, batch)
    stored = S.metric_table(spark, metric)
    assert stored.count() == 2 and stored.columns[:4] == ["stt", "edt", "register_ct", "ts"]
