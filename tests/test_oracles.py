"""Every registered query of the catalogue against its oracle."""

import pytest
from oracle import connect, rows

from quillon.plans import business, catalog, classifiers, documents, probes, relational, reports, resolution, scalars, workbook  # noqa: F401


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_oracle(name, spark, small, duck):
    got = catalog.QUERIES[name](spark, small)
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
