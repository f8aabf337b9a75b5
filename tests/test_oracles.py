import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tremorlake.plans.oracles import ORACLES
from tremorlake.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) > 0


def test_entry(spark):
    assert entry(spark).count() == 450


@pytest.mark.parametrize("name, rows", [
    ("normalize_events", 900), ("normalize_rejects", 100), ("dedup_first_seen", 450),
    ("html_page_counts", 67), ("html_cells", 967), ("html_records", 935)])
def test_known_row_counts(spark, name, rows):
    assert queries()[name](spark, "/root/testdata/sf0.001").count() == rows
