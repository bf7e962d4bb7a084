"""Keyed rules: edges by hand, then against per-key state machines on random rows."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyflow.functions.timefmt import at, day_text
from tallyflow.operators import keyed as K

DAY_MS = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def rows_of(spark, rows, schema="id int, k string, ms long"):
    return spark.createDataFrame(rows, schema)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


# --- bounce ----------------------------------------------------------------
def bounce_ids(spark, rows):
    df = spark.createDataFrame(rows, "id int, k string, ms long, last string")
    return ids(K.bounces(df, "k", F.col("last").isNull(), "ms", ["ms", "id"]))


def test_bounce_edges(spark):
    assert bounce_ids(spark, [(1, "a", T0, None), (2, "a", T0 + 9_999, "x")]) == []
    # a follower after exactly 10 s is too late
    assert bounce_ids(spark, [(1, "a", T0, None), (2, "a", T0 + 10_000, "x")]) == [1]
    # another entry page follows at once: the first bounced, the second waits alone
    assert bounce_ids(spark, [(1, "a", T0, None), (2, "a", T0 + 1, None)]) == [1, 2]
    # not an entry page
    assert bounce_ids(spark, [(1, "a", T0, "x")]) == []


def test_bounce_across_time_blocks(spark):
    edge = (T0 // 600_000 + 1) * 600_000
    rows = [(1, "a", edge - 3, None), (2, "a", edge + 5, "x"), (3, "a", edge + 20_000, None)]
    assert bounce_ids(spark, rows) == [3]


# --- de-dup ----------------------------------------------------------------
def test_first_wins_with_fading_memory(spark):
    rows = [(1, "a", T0), (2, "a", T0 + 4_999), (3, "a", T0 + 9_998), (4, "a", T0 + 14_998), (5, "b", T0)]
    assert ids(K.first_wins_within(rows_of(spark, rows), "k", "ms", ["ms", "id"])) == [1, 4, 5]


def test_last_wins_tie_goes_to_later_arrival(spark):
    rows = [(1, "a", T0), (2, "a", T0), (3, "b", T0 + 1), (4, "b", T0)]
    assert ids(K.last_per(rows_of(spark, rows), "k", ["ms", "id"])) == [2, 3]


# --- days ------------------------------------------------------------------
def with_day(df):
    return df.withColumn("day", day_text(at("ms")))


def test_return_after_exactly_eight_days(spark):
    rows = [(1, "a", T0), (2, "a", T0 + 8 * DAY_MS), (3, "a", T0 + 15 * DAY_MS), (4, "a", T0 + 15 * DAY_MS + 5)]
    got = K.day_changes(with_day(rows_of(spark, rows)), "k", "day", ["ms", "id"])
    assert sorted((r["id"], r["is_first"], r["days_away"]) for r in got.collect()) == [
        (1, True, None),
        (2, False, 8),
        (3, False, 7),
    ]


def logs(spark, rows):
    df = spark.createDataFrame(rows, "id int, mid string, is_new string, ts long")
    return df.select("id", F.struct("mid", "is_new").alias("common"), "ts")


def flags(df):
    return {r["id"]: r["common"]["is_new"] for r in df.collect()}


def test_new_flag_repair(spark):
    rows = [
        (1, "a", "1", T0),
        (2, "a", "1", T0 + 5),
        (3, "a", "1", T0 + DAY_MS),  # says new on a later day
        (4, "b", "0", T0),  # first seen as old: first day is yesterday
        (5, "b", "1", T0 + 5),
    ]
    assert flags(K.repair_new_flag(logs(spark, rows))) == {1: "1", 2: "1", 3: "0", 4: "0", 5: "0"}


# --- state machines --------------------------------------------------------
def _day(ms):
    return datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%d")


def machine(rows):
    """(id, key, ms, is_new, last) in time order to the ids each rule lets through."""
    out = {"unique": [], "flags": {}, "bounce": [], "ttl": [], "user": {}}
    last_day, first_day, seen, pending = {}, {}, {}, {}
    for i, k, ms, is_new, last in rows:
        day = _day(ms)
        out["user"][i] = (int(last_day.get(k) != day), int(k not in last_day))
        if last_day.get(k) != day:
            out["unique"].append(i)
            last_day[k] = day
        flag = is_new
        if is_new == "1":
            if k not in first_day:
                first_day[k] = day
            elif first_day[k] != day:
                flag = "0"
        elif k not in first_day:
            first_day[k] = _day(ms - DAY_MS)
        out["flags"][i] = flag
        if k not in seen or ms - seen[k] >= 5_000:
            out["ttl"].append(i)
        seen[k] = ms
        if k in pending:
            j, then = pending.pop(k)
            if ms - then >= 10_000 or last is None:
                out["bounce"].append(j)
        if last is None:
            pending[k] = (i, ms)
    out["bounce"] += [j for j, _ in pending.values()]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_rules_equal_state_machines(spark, seed):
    rng = random.Random(seed)
    ms, rows = T0, []
    for i in range(400):
        ms += rng.choice([1, 500, 2_500, 5_000, 10_000, 40_000, DAY_MS // 3])
        rows.append((i, rng.choice("aaab"), ms, rng.choice("01"), rng.choice([None, "x"])))
    want = machine(rows)
    df = spark.createDataFrame(rows, "id int, k string, ms long, is_new string, last string")
    timed = df.withColumn("day", day_text(at("ms"))).withColumn("rt", at("ms"))
    assert ids(K.day_firsts(timed, "k", "day", ["ms", "id"])) == want["unique"]
    assert ids(K.bounces(df, "k", F.col("last").isNull(), "ms", ["ms", "id"])) == sorted(want["bounce"])
    assert ids(K.first_wins_within(df, "k", "ms", ["ms", "id"])) == want["ttl"]
    log = df.select("id", F.struct(F.col("k").alias("mid"), "is_new").alias("common"), F.col("ms").alias("ts"))
    assert flags(K.repair_new_flag(log, ["ts", "id"])) == want["flags"]
    users = K.user_flags(timed, "k", "day", "rt", ["ms", "id"])
    assert {r["id"]: (r["unique_user"], r["new_user"]) for r in users.collect()} == want["user"]
