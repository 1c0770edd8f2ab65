"""Every registered query equals its DuckDB oracle (row count, columns, values) on sf0.001."""

import pytest

import __spark_entry__ as entry
from tally.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle_compare import fingerprint

KEYS = sorted(registry.QUERY_BUILDERS)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["l_returnflag", "l_linestatus"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck_small, key):
    df = entry.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck_small.execute(entry.oracle_sql()[key])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert fingerprint(df.columns, got)[0] == fingerprint(want_cols, want)[0]
