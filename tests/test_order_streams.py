"""Order lines, extras, order versions and payments met over several micro-batches, inside and outside their bounds."""

import json

from tallyflow.operators import facts as X
from tallyflow.sources import feeds as S
from tallyflow.sources import sinks as W

START = 1_700_000_000
DICTIONARY = [("1", "search"), ("2", "card")]


def change(table, at, kind="insert", old=None, **data):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": str(START + at), "data": data, "old": old})


def line(id, order, at):
    return change("order_detail", at, id=id, order_id=order, sku_id="s", source_type="1", create_time="2023-11-14 22:13:20")


def extra(kind, id, of, order, at, made):
    return change(f"order_detail_{kind}", at, id=id, order_id=order, order_detail_id=of, **{f"{kind}_id": id, "create_time": made})


def order(id, at, status="1001", **more):
    return change("order_info", at, id=id, order_status=status, user_id="u", **more)


#: Arrival by micro-batch: what belongs together comes apart, in either order, and some of it too far off.
BATCHES = [
    [line("l1", "o1", 0), line("l2", "o1", 4), extra("activity", "a1", "l1", "o1", 2, "2023-01-01"), line("alone", "o2", 1)],
    [order("o1", 1), extra("activity", "a2", "l1", "o1", 5, "2023-01-02"), extra("activity", "far", "l1", "o1", 6, "2023-01-03"), extra("coupon", "c1", "l2", "o1", 3, "2023-01-01")],
    [line("l3", "o1", 7), order("o1", 6, "1003", kind="update", old={"order_status": "1001"}, operate_time="2023-11-15 00:00:00"), order("o2", 7)],
    [line("l4", "o3", 40), order("o3", 45)],
    *[[line(f"end{i}", f"end{i}", 100_000 + 1000 * i), order(f"end{i}", 100_000 + 1000 * i)] for i in range(3)],
]


def feed(spark, folder, batches, table=None):
    """Lines as text, one file and one micro-batch for each list."""
    for i, rows in enumerate(batches):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(str(folder))
    return S.change_rows(S.folder_lines(spark, str(folder), files_per_batch=1))


def drained(spark, df, folder, tag):
    out = f"{folder}/{tag}-out"
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
    query = W.start(df, write, f"{folder}/{tag}-progress", available_now=True)
    query.awaitTermination()
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch"), query.recentProgress


def test_lines_meet_what_is_inside_the_bounds(spark, tmp_path):
    dictionary = spark.createDataFrame(DICTIONARY, "dic_code string, dic_name string")
    wide = X.stream_order_wide(feed(spark, tmp_path / "feed", BATCHES), dictionary, delay="60 seconds")
    rows, progress = drained(spark, wide, tmp_path, "wide")
    got = {(r.id, r.type, r.activity_id, r.coupon_id, r.order_status) for r in rows.collect() if not r.id.startswith("end")}
    assert got == {
        ("l1", "insert", "a2", None, "1001"),
        ("l2", "insert", None, "c1", "1001"),
        ("l2", "update", None, "c1", "1003"),
        ("l3", "update", None, None, "1003"),
        ("l4", "insert", None, None, "1001"),
    }
    assert [r.id for r in X.cancelled_details(rows).orderBy("id").collect()] == ["l2", "l3"]
    held = [sum(s["numRowsTotal"] for s in json.loads(p.json)["stateOperators"]) for p in progress]
    # Five orders' parts were held; what is left belongs to the closing orders alone.
    assert max(held) >= 2 and held[-1] <= 3


def test_a_payment_meets_lines_up_to_905_seconds_away(spark, tmp_path):
    dictionary = spark.createDataFrame(DICTIONARY, "dic_code string, dic_name string")
    others = "user_id sku_id sku_name sku_num order_price province_id activity_id activity_rule_id coupon_id source_id source_type_id source_type_name split_activity_amount split_coupon_amount".split()
    lines = [("a", "o1", START), ("b", "o1", START + 3), ("c", "o2", START), ("d", "o3", START + 1800), ("e", "o4", START + 2000)]
    for i, part in enumerate((lines[:3], lines[3:])):
        table = spark.createDataFrame([(k, o, at, "1.00") for k, o, at in part], "id string, order_id string, at long, split_total_amount string")
        table = table.selectExpr("id", "order_id", "timestamp_seconds(at) as row_op_ts", "split_total_amount", *[f"cast(null as string) as {c}" for c in others])
        table.coalesce(1).write.mode("append").parquet(str(tmp_path / "lines"))
    paid = lambda o, at: change("payment_info", at, "update", {"payment_status": "1601"}, order_id=o, payment_type="2", payment_status="1602")
    payments = feed(spark, tmp_path / "payments", [[paid("o1", 905)], [paid("o2", 906), paid("o3", 895), paid("o4", 1094)]])
    stream = S.table_stream(spark, str(tmp_path / "lines"), table.schema, files_per_batch=1)
    rows, _ = drained(spark, X.stream_paid_details(payments, stream, dictionary, delay="3000 seconds"), tmp_path, "paid")
    # c is 906 seconds before its payment and e is 906 after it; d comes after its payment.
    assert sorted(r.order_detail_id for r in rows.collect()) == ["a", "b", "d"]


def refund(id, order, at):
    return change("order_refund_info", at, id=id, order_id=order, sku_id="s", refund_num="1", refund_type="1", refund_reason_type="2", create_time="2023-11-14 22:13:20")


def test_only_payments_of_refunded_orders_are_held_for_requests(spark, tmp_path):
    dictionary = spark.createDataFrame(DICTIONARY, "dic_code string, dic_name string")
    paid = lambda i: change("refund_payment", i, "update", {"refund_status": "0701"}, id=f"p{i}", order_id=f"o{i}", sku_id="s", payment_type="2", total_amount="1.00", callback_time="2023-11-15 00:00:00")
    done = [order(f"o{i}", i, "1006", kind="update", old={"order_status": "1005"}) for i in (3, 7)]
    batches = [[paid(i) for i in range(20)], [refund(f"r{i}", f"o{i}", i) for i in range(20)], done]
    rows = X.stream_refunds_paid(feed(spark, tmp_path / "feed", batches), dictionary, within="31 days")
    got, progress = drained(spark, rows, tmp_path, "refunds")
    assert {(r.id, r["_request"], r.order_id, r.refund_num, r.row_op_ts.timestamp()) for r in got.collect()} == {
        ("p3", "r3", "o3", "1", START + 3.0),
        ("p7", "r7", "o7", "1", START + 7.0),
    }
    held = [sum(s["numRowsTotal"] for s in json.loads(p.json)["stateOperators"]) for p in progress]
    # 20 payments, 20 requests, two orders and two payments that have met theirs; before, all payments were held twice.
    assert max(held) == 44


def test_a_refund_stream_has_a_batch_for_each_slice_and_its_settings_stay_its_own(spark, sf_dir, monkeypatch):
    from tallyflow.plans import stream_catalog as C
    from tallyflow.session import JOIN_STATE

    seen, start = [], W.start

    def started(*args, **more):
        query = start(*args, **more)
        seen.append((query, more.get("conf")))
        return query

    monkeypatch.setattr(W, "start", started)
    before = {key: spark.conf.get(key, None) for key in JOIN_STATE}
    assert C.QUERIES["stream_refund_detail"](spark, sf_dir).count() > 0
    (query, conf), = seen
    # Closing records would add a batch each that reads all state again; one batch without rows may follow the last.
    assert len([p for p in query.recentProgress if p.numInputRows]) == len(C._SLICES)
    assert conf == JOIN_STATE and {key: spark.conf.get(key, None) for key in JOIN_STATE} == before
