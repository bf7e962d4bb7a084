"""Every query against its independent SQL."""

import pytest
from check_oracle import compare

import __spark_entry__ as entry
from tallyflow.plans.stream_catalog import QUERIES as OWN

QUERIES, ORACLES = {k: v for k, v in entry.queries().items() if k in OWN}, entry.oracle_sql()
# Empty on the smallest tables by the rule itself.
MAY_BE_EMPTY = {"no rows on either side"}


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(OWN) <= set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["ch", "uv_ct"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, sf_dir, name):
    diff = compare(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name])
    assert diff is None or diff in MAY_BE_EMPTY
