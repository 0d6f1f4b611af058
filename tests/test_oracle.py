"""Every registered query against its DuckDB oracle SQL (the driver's correctness gate)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from kpiframe.queries import oracle, registry
from kpiframe.sources.tables import DRIVER_TABLES

from conftest import SF_ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return c


def normalized(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else x
        return x.isoformat() if hasattr(x, "isoformat") else x

    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_oracle_sql():
    """The reports' queries all have one; of the optional ones only those that SQL can express."""
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_ORACLE)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert normalized(df.columns, df.collect()) == normalized(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["report_id", "slot", "value"] and len(rows) == 67
