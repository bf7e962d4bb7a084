"""Steps that grew faster than their input: what is shuffled, sorted and called for each key."""

from pyspark.sql import Row

import __spark_entry__ as entry
from tallyflow.operators import facts as X
from tallyflow.plans import table_feeds as A
from tallyflow.streaming import keyed as K

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_routing_moves_no_changes(spark, sf_dir):
    """The configuration is broadcast; feeds it does not name are not even read."""
    text = plan(QUERIES["dim_route"](spark, sf_dir))
    assert "Exchange hashpartitioning(table" not in text
    assert "lineitem.parquet" not in text and "events.parquet" not in text
    assert "hashpartitioning(table" not in plan(QUERIES["dim_upsert_latest"](spark, sf_dir))


class _Handle:
    """State and timers of one key; counts the calls."""

    def __init__(self):
        self.held, self.timers, self.calls = None, set(), []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.held

    def exists(self):
        return self.held is not None

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None

    def registerTimer(self, at):
        self.timers.add(at)
        self.calls.append(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class _Now:
    def __init__(self, at):
        self.at = at

    getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: self.at


def test_one_timer_for_all_open_days_of_a_key():
    day_ms, first = 86_400_000, 1_704_067_200_000  # 2024-01-01
    rows = [Row(id=d, day=f"2024-01-{d:02d}", event_ms=first + (d - 1) * day_ms) for d in (3, 2, 5, 2, 4)]
    handle, rule = _Handle(), K.DayFirsts("day", "UTC")
    rule.columns = ["id", "day"]
    rule.init(handle)
    assert [r.id for r in rule.handleInputRows(("a",), iter(rows), _Now(first))] == [2, 3, 4, 5]
    assert handle.calls == [first + 2 * day_ms]
    # An older day that opens late moves the timer; a known day gives nothing out.
    late = [Row(id=1, day="2024-01-01", event_ms=first), Row(id=9, day="2024-01-05", event_ms=first)]
    assert [r.id for r in rule.handleInputRows(("a",), iter(late), _Now(first))] == [1]
    assert handle.timers == {first + day_ms}
    # Time that has passed four days takes all of them at once.
    handle.timers.clear()
    list(rule.handleExpiredTimer(("a",), _Now(first + 4 * day_ms), _Now(first + day_ms)))
    assert handle.held == (["2024-01-05"],) and handle.timers == {first + 5 * day_ms}
    list(rule.handleExpiredTimer(("a",), _Now(first + 5 * day_ms), _Now(first + 5 * day_ms)))
    assert handle.held is None


def test_routed_counts_make_no_maps(spark, sf_dir):
    assert " map(" not in plan(QUERIES["cdc_route"](spark, sf_dir))


def test_facts_from_few_orders_are_the_same(spark, sf_dir):
    """Paid and cancelled lines from the orders on, against the same facts out of all order lines."""
    feeds = A.feeds(spark, sf_dir, "order_info", "order_detail", "order_detail_activity", "order_detail_coupon", "payment_info")
    codes = A.dictionary(spark, sf_dir)
    wide = X.order_wide(feeds, codes, A.SHOP)
    for few, all_lines in (
        (X.order_payments(feeds, codes, A.SHOP), X.paid_details(feeds, X.order_details(wide), codes)),
        (X.order_cancellations(feeds, codes, A.SHOP), X.cancelled_details(wide)),
    ):
        assert few.columns == all_lines.columns
        assert few.count() > 0
        assert few.exceptAll(all_lines).isEmpty() and all_lines.exceptAll(few).isEmpty()


def test_wide_lines_are_not_sorted_for_their_joins(spark, sf_dir):
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    df = QUERIES["order_detail"](spark, sf_dir)
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df = df.select("*")
        df.collect()
        final = plan(df).split("Initial Plan")[0]
        assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
