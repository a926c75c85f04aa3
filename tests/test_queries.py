"""Every query against DuckDB on the smallest tables; those without SQL must give rows."""

import pytest
from conftest import DATA
from oracle import connection, same

from tarnflow.plans import registry


@pytest.fixture(scope="module")
def con():
    return connection(DATA)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    frame = registry.queries()[name](spark, DATA)
    if name in registry.oracle_sql():
        same(frame, con, registry.oracle_sql()[name])
    else:
        assert frame.count() > 0


def test_entry_runs_and_names_agree(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["project", "seq", "size", "first_idx", "header"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
