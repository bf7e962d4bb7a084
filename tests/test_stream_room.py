"""What streams write and hold: laid down feeds are compressed and not shuffled, orders that no fact takes are not held."""

import pytest

from test_order_streams import BATCHES, DICTIONARY

from tallyflow.operators import facts as X
from tallyflow.functions import predicates as P
from tallyflow.plans import stream_catalog as C
from tallyflow.sources import feeds as S
from tallyflow.streaming import keyed as K


def test_a_feed_is_compressed_in_one_file_for_each_part(spark, tmp_path):
    folder = str(tmp_path / "feed")
    line = '{"database":"shop","table":"order_info","type":"insert","ts":"%d","data":{"id":"%d"},"old":null}'
    for turn, read in enumerate((20, 3, 20)):
        rows = spark.range(0, 1000, 1, read).selectExpr(f"format_string('{line}', id, id) as value")
        # In the last turn most parts have no row.
        C._lay_down(rows.where("value like '%\"id\":\"7\"%'") if turn == 2 else rows, folder, 8)
        files = C._files(spark, folder)
        assert len(files) == 8 * (turn + 1) and all(f.endswith(".gz") for f in files)
    assert S.change_rows(S.folder_lines(spark, folder, stream=False)).count() == 2001


def test_rows_read_in_enough_parts_are_not_shuffled(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 100, 1, 9).selectExpr("cast(id as string) as value")
    monkeypatch.setattr(type(rows), "repartition", lambda *_: pytest.fail("a shuffle"))
    C._lay_down(rows, str(tmp_path / "feed"), 8)


@pytest.mark.parametrize("shape, versions", [(X.order_details, X.is_new_order), (X.cancelled_details, lambda: X.is_cancellation(P.new("order_status")))])
def test_only_orders_that_a_fact_takes_are_held(spark, monkeypatch, shape, versions):
    lines = spark.createDataFrame([(r,) for batch in BATCHES for r in batch], "value string")
    changes, dictionary = S.change_rows(lines), spark.createDataFrame(DICTIONARY, "dic_code string, dic_name string")
    held, meet = [], K.order_lines
    monkeypatch.setattr(K, "order_lines", lambda parts, *more: held.append(parts.where(f"kind = '{K.ORDER}'").count()) or meet(parts, *more))
    every, few = (shape(X.stream_order_wide(changes, dictionary, **more)) for more in ({}, {"versions": versions()}))
    assert held[0] == 7 and held[1] == (6 if shape is X.order_details else 1)
    assert few.count() > 0 and sorted(map(str, few.collect())) == sorted(map(str, every.collect()))
