"""The registered queries that have SQL, against DuckDB."""
import pytest
from compare import connect, rows_of

import __spark_entry__ as entry
from tickloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query(run_query, sf_dir, key):
    rows = run_query(key)
    cursor = connect(sf_dir).execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(names) == sorted(rows[0].__fields__)
    assert rows_of(rows[0].__fields__, [tuple(r) for r in rows]) == rows_of(names, want)


def test_entry_has_them():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
