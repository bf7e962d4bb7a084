"""State of daily-unique rules on streams: right across midnight, and gone after the day."""

import pytest
from pyspark.sql import functions as F

from tallyflow.plans import metrics as M
from tallyflow.sources import feeds as S
from tallyflow.sources import sinks as W
from tallyflow.streaming import keyed as K

#: Each list is one micro-batch of (id, key, time).
BATCHES = [
    [(1, "a", "2024-01-01 10:00:00"), (2, "a", "2024-01-01 09:59:59"), (3, "b", "2024-01-01 23:59:58")],
    # Rows of both days after a row of the newer one: the older day is still open.
    [(4, "a", "2024-01-02 00:00:01"), (5, "b", "2024-01-02 00:00:00")],
    [(6, "b", "2024-01-01 23:59:59"), (7, "c", "2024-01-01 23:59:59"), (8, "a", "2024-01-02 00:00:03")],
    [(9, "c", "2024-01-02 12:00:00"), (10, "a", "2024-01-02 13:00:00"), (11, None, "2024-01-02 13:00:00")],
    # Late: its day is closed, its state gone.
    [(12, "a", "2024-01-01 11:00:00"), (13, "b", "2024-01-03 09:00:00")],
    [(14, "end", "2024-01-05 00:00:03")],
    [(15, "end", "2024-01-06 00:00:03")],
]


def laid(spark, path, batches, cast="id long, key string, text string"):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, cast).coalesce(1).write.mode("append").parquet(path)
    schema = spark.createDataFrame([], cast).schema
    return S.table_stream(spark, path, schema, files_per_batch=1)


def drained(spark, df, folder, tag):
    out = f"{folder}/{tag}-out"
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
    query = W.start(df, write, f"{folder}/{tag}-progress", available_now=True, state_parts=2)
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*"), states


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_day_firsts_forget_closed_days(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = laid(spark, str(tmp_path / "in"), BATCHES).select(
            "id", "key", F.to_timestamp("text").alias("rt"), F.substring("text", 1, 10).alias("day")
        )
        got, states = drained(spark, K.day_firsts(rows, "key", "day", "rt"), tmp_path, "firsts")
        assert sorted(r["id"] for r in got.collect()) == [2, 3, 4, 5, 7, 9, 11, 13, 14, 15]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert max(states) >= 3
    # Two days after the last row of a, b and c only the closing key's last day is open.
    assert states[-1] <= min(s for s in states if s) and states[-1] < max(states)


def test_cart_users_of_a_stream(spark, tmp_path):
    carts = laid(spark, str(tmp_path / "in"), BATCHES).select(
        "id", F.col("key").alias("user_id"), F.lit(None).cast("string").alias("operate_time"), F.col("text").alias("create_time")
    )
    got, _ = drained(spark, M.cart_add_uu(carts, "1 day"), tmp_path, "carts")
    # The last window waits for time to pass it.
    counts = {r["stt"][:10]: r["cart_add_uu_ct"] for r in got.collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 4, "2024-01-03": 1, "2024-01-05": 1}
