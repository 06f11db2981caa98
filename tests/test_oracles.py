"""Every registered query against its SQL in DuckDB."""
import pytest
from compare import check, connect

import __spark_entry__ as entry
from tickloom.registry import ORACLES, QUERIES

# fits twenty models; test_search_ranks_its_trials runs fewer
SLOW = {"random_search"}
# rows exist only in denser data than the smallest scale
MAY_BE_EMPTY = {"error_burst_alert", "stream_error_bursts", "sustained_alert"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in SLOW])
def test_query(spark, con, sf_dir, key):
    problem = check(spark, con, sf_dir, key, QUERIES, ORACLES)
    if problem == "no rows" and key in MAY_BE_EMPTY:
        return
    assert problem is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert "y_fwd_ret_5" in df.columns and df.count() > 0
