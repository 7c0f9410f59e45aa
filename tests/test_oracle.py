"""Every catalog query against its DuckDB SQL on the smallest tables (the
driver runs the same check at sf0.01); rows-only entries must run."""

import pytest

import oracle
from marketlens.plans.catalog import entries

from conftest import SMALL

ENTRIES = entries()


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SMALL)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query_matches_sql(spark, con, name):
    e = ENTRIES[name]
    if e.sql is None:
        assert e.fn(spark, SMALL).count() >= 0
        return
    r = oracle.compare(spark, con, SMALL, e)
    assert r["ok"], r


def test_driver_contract():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    # training-data queries join the catalog where their package is installed
    assert set(ENTRIES) <= set(q) and set(s) <= set(q)
    assert {n for n in s if n in ENTRIES} == {n for n, e in ENTRIES.items() if e.sql is not None}
