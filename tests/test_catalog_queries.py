"""Every catalog query against its SQL."""

import pytest
from support import DATA, same_rows

from gneiss.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    if name in ORACLES:
        cursor = oracle.execute(ORACLES[name])
        same_rows(df.columns, rows, [c[0] for c in cursor.description], cursor.fetchall())


def test_entry_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
