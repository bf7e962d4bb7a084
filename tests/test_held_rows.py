"""Rules that hold rows until their time has come run as aggregates, without a Python call for each key."""

import pytest
from pyspark.sql import functions as F

from test_day_state import drained, laid

from tallyflow.operators import facts as X
from tallyflow.sources import feeds as S
from tallyflow.streaming import keyed as K

ENTRIES = "id long, key string, text string, entry boolean"
#: Gap of ten seconds: a follower exactly that much later is too late; one window's edge lies between 6 and 7.
BATCHES = [
    [(1, "a", "2024-01-01 00:00:00", True), (3, "a", "2024-01-01 00:00:15", True), (2, "a", "2024-01-01 00:00:05", False)],
    [(4, "a", "2024-01-01 00:00:25", False), (5, "b", "2024-01-01 00:00:19", True), (6, "b", "2024-01-01 00:00:28", True)],
    [(7, "b", "2024-01-01 00:00:31", False), (8, None, "2024-01-01 00:00:40", True), (9, "c", "2024-01-01 00:00:41", None)],
    [(90, "end", "2024-01-02 00:00:00", True)],
    [(91, "end", "2024-01-03 00:00:00", True)],
]


def python_steps(df):
    text = df._jdf.queryExecution().analyzed().toString()
    return [step for step in ("TransformWithState", "InPandas", "InPySpark", "InArrow") if step in text]


@pytest.fixture
def stream(spark, tmp_path):
    return laid(spark, str(tmp_path / "in"), BATCHES, ENTRIES).withColumn("rt", F.to_timestamp("text"))


def test_bounces_over_window_edges(spark, tmp_path, stream):
    found = K.bounces(stream, "key", "entry", "rt", "10 seconds", "60 seconds")
    assert not python_steps(found)
    got, _ = drained(spark, found, tmp_path, "bounce")
    assert sorted(r.id for r in got.where("id < 90").collect()) == [3, 5, 8]
    assert found.columns == stream.columns


def test_newest_version_of_a_hold(spark, tmp_path):
    rows = laid(
        spark,
        str(tmp_path / "in"),
        [
            [(2, "a", "2024-01-01 00:00:04"), (1, "a", "2024-01-01 00:00:00"), (3, "b", "2024-01-01 00:00:01")],
            [(0, "b", "2024-01-01 00:00:02"), (5, "a", "2024-01-01 00:10:00")],
            [(90, "end", "2024-01-02 00:00:00")],
            [(91, "end", "2024-01-03 00:00:00")],
        ],
    ).withColumn("rt", F.to_timestamp("text"))
    found = K.last_wins(rows, "key", "id", "rt", "5 seconds", "60 seconds")
    assert not python_steps(found)
    got, _ = drained(spark, found, tmp_path, "last")
    assert sorted(r.id for r in got.where("id < 90").collect()) == [2, 3, 5]
    assert found.columns == rows.columns


def test_order_lines_without_python(spark, tmp_path):
    (tmp_path / "none").mkdir()
    feed = S.change_rows(S.folder_lines(spark, str(tmp_path / "none")))
    dictionary = spark.createDataFrame([], "dic_code string, dic_name string")
    assert not python_steps(X.stream_order_wide(feed, dictionary))
