"""Every registered query of the restore engine against its SQL in DuckDB."""

import duckdb
import pytest

from chronofold.plans.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.execute(f"create view events as select * from '{sf_dir}/events.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.sql(oracle_sql()[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
