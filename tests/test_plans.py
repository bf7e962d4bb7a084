"""Physical plans: what is read, what is shuffled, what never happens."""

import pytest

import __spark_entry__ as entry
from tallyflow.plans.stream_catalog import QUERIES as OWN

QUERIES = entry.queries()
TABLE_QUERIES = [n for n in OWN if not n.startswith("stream_")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text


def test_dedup_cuts_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["dedup_last"](spark, sf_dir))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text and "Final" in text


def test_unused_columns_and_tables_are_not_read(spark, sf_dir):
    text = plan(QUERIES["user_register"](spark, sf_dir))
    assert "ReadSchema: struct<c_custkey:bigint>" in text
    text = plan(QUERIES["daily_unique_visitor"](spark, sf_dir))
    assert "value" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize(
    "name, unused",
    [
        ("win_order", ["o_totalprice", "o_orderpriority", "l_suppkey"]),
        ("win_user_spu", ["o_totalprice", "o_orderpriority", "l_suppkey"]),
        ("win_province", ["o_orderpriority", "l_suppkey", "l_tax", "l_discount"]),
        ("win_cart_uu", ["value"]),
        ("win_refund", ["o_totalprice", "o_orderpriority", "l_tax"]),
    ],
)
def test_metrics_read_only_what_they_use(spark, sf_dir, name, unused):
    read = " ".join(part.split("\n")[0] for part in plan(QUERIES[name](spark, sf_dir)).split("ReadSchema")[1:])
    assert not [c for c in unused if c in read]


@pytest.mark.parametrize("name", ["dim_snowflake", "win_user_spu", "win_refund"])
def test_facts_are_not_shuffled_by_category(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.1"))
    assert "hashpartitioning(category" not in text


def test_filters_reach_the_scan(spark, sf_dir):
    assert "EqualTo(o_orderstatus,F)" in plan(QUERIES["cdc_changed_to"](spark, sf_dir)) or "o_orderstatus" in plan(
        QUERIES["cdc_changed_to"](spark, sf_dir)
    )
    assert "EqualTo(l_returnflag,R)" in plan(QUERIES["refund_detail"](spark, sf_dir))


def test_hot_key_is_split(spark):
    """One key owns most rows and the other side is an aggregate: AQE splits it."""
    from pyspark.sql import functions as F

    from tallyflow.operators.joins import hot_key_join
    from tallyflow.operators.keyed import repair_new_flag

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 10 < 6, 0, id % 1000) as k", "id", "uuid() as pad")
        one = rows.groupBy("k").agg(F.min("id").alias("first"))
        joined = hot_key_join(rows, one, ["k"])
        logs = rows.selectExpr(
            "named_struct('mid', cast(k as string), 'is_new', '1') as common", "id * 1000 as ts", "pad"
        )
        for df, made in ((joined, "first"), (repair_new_flag(logs), "common.is_new")):
            total = df.agg(F.max(made).alias("top"), F.count(F.lit(1)).alias("n"))
            assert total.collect()[0]["n"] == 200_000
            assert "skew=true" in plan(total)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
