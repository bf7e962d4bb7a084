"""Report edges: empty day, one visitor kind, order of rows, full joins, series."""

import json

from pyspark.sql import functions as F

from tallyflow import schemas
from tallyflow.plans import reports as R

DAY = 20240110
STT, EDT = "2024-01-10 05:00:00", "2024-01-10 05:00:10"
TEXT = {"stt", "edt", "vc", "ch", "ar", "is_new", "source", "keyword", "user_id"}


def metric(spark, name, *rows):
    def kind(c):
        if c in TEXT or c.endswith(("_id", "_name")):
            return "string"
        return "double" if c.endswith("amount") else "long"

    schema = ", ".join(f"{c} {kind(c)}" for c in schemas.METRICS[name])
    return spark.createDataFrame([(STT, EDT, *r) for r in rows], schema)


CAT = ("c1", "C1", "c2", "C2", "c3", "C3")


def spu(spark, *rows):
    return metric(spark, "user_spu_order", *[(t, n, *CAT, u, "s", "S", c, a) for t, n, u, c, a in rows])


def refund(spark, *rows):
    return metric(spark, "refund", *[(t, n, *CAT, u, c) for t, n, u, c in rows])


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_top_trademarks_keep_order_and_break_ties_by_name(spark):
    orders = spu(spark, ("1", "b", "u", 1, 5.0), ("2", "a", "u", 1, 5.0), ("3", "c", "u", 1, 9.0), ("4", "d", "u", 1, 1.0))
    assert tuples(R.top_trademarks(orders, DAY, 3)) == [("c", 9.0), ("a", 5.0), ("b", 5.0)]
    assert tuples(R.top_trademarks(orders, 20240111, 3)) == []


def test_orders_and_refunds_meet_from_both_sides(spark):
    orders = spu(spark, ("1", "x", "u1", 2, 5.0), ("1", "x", "u2", 1, 5.0))
    refunds = refund(spark, ("2", "y", "u3", 4))
    assert sorted(tuples(R.trademark_orders_refunds(orders, refunds, DAY))) == [
        ("x", 3, 2, 10.0, 0, 0),
        ("y", 0, 0, 0.0, 4, 1),
    ]
    assert sorted(tuples(R.category_orders_refunds(orders, refunds, DAY))) == [("C1", "C2", "C3", 3, 2, 10.0, 4, 1)]


def test_totals_of_an_empty_day_are_zero(spark):
    stats = R.trade_stats(spu(spark), refund(spark), DAY)
    assert sorted(tuples(stats)) == [("order_count", 0), ("order_users", 0), ("refund_count", 0), ("refund_users", 0)]
    assert tuples(R.activity_subsidy(metric(spark, "order"), DAY)) == []


def test_subsidy_without_sales_is_null(spark):
    orders = metric(spark, "order", (1, 1, 2.0, 3.0, 0.0))
    assert tuples(R.activity_subsidy(orders, DAY)) == [(2.0, 0.0, None)]


def test_one_visitor_kind_only(spark):
    traffic = metric(spark, "traffic", ("v", "c", "a", "1", 1, 2, 6, 3000, 1))
    rows = {r["type"]: (r["new"], r["old"]) for r in R.visitor_types(traffic, DAY).collect()}
    assert rows == {"uv": (1, 0), "pv": (6, 0), "uj_rate": (0.5, 0.0), "avg_dur": (1.5, 0.0), "avg_pv": (3.0, 0.0)}


def test_hours_are_filled_and_sorted(spark):
    traffic = metric(spark, "traffic", ("v", "c", "a", "1", 3, 2, 6, 3000, 1))
    rows = tuples(R.visitors_per_hour(traffic, DAY))
    assert [r[0] for r in rows] == [f"{h:02d}" for h in range(24)]
    assert rows[5] == ("05", 3, 6, 3) and rows[6] == ("06", 0, 0, 0)


def test_keyword_weights_ignore_case_of_source(spark):
    words = metric(spark, "keyword", ("search", "a", 2), ("ORDER", "a", 1), ("cart", "b", 1), ("other", "c", 9))
    assert tuples(R.keyword_scores(words, DAY)) == [("a", 25), ("b", 2), ("c", 0)]


def test_channel_without_sessions(spark):
    traffic = metric(spark, "traffic", ("v", "c", "a", "1", 1, 0, 6, 1, 1), ("v", "d", "a", "1", 1, 2, 6, 1, 1))
    assert tuples(R.pages_per_session(traffic, DAY)) == [("d", 3.0), ("c", None)]


def test_series_follow_report_order(spark):
    report = spark.createDataFrame([("x", 1), ("y", 5)], "ch string, uv_ct long")
    text = R.series_json(report, "ch", ["uv_ct"], [-F.col("uv_ct")]).first()["payload"]
    assert json.loads(text) == {"categories": ["y", "x"], "uv_ct": [5, 1]}


def test_day_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = metric(spark, "login", (1, 2)).withColumn("dt", F.substring("stt", 1, 10))
    rows.write.partitionBy("dt").parquet(path)
    day = R.on_day(spark.read.parquet(path), DAY)
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 1
