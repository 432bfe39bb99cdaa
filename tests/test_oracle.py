import os

import pytest

import __spark_entry__ as registered
import entry_oracles
import entry_queries
from check_oracles import difference, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(entry_queries.QUERIES) == set(entry_oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    frame = registered.queries()[name](spark, SF_DIR).toArrow()
    expected = con.sql(registered.oracle_sql()[name]).to_arrow_table()
    wanted = dict(timestamp_as_object=True, date_as_object=True)
    assert difference(frame.to_pandas(**wanted), expected.to_pandas(**wanted)) == ""


def test_entry(spark):
    assert registered.entry(spark).columns == ["etl_dt", "start_dt", "user_id", "event_type", "end_dt"]
