"""Every registered query with a SQL counterpart, run side by side on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    return repr(value)


def canonical(rows, names):
    order = [names.index(name) for name in sorted(names)]
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF)
    result = tables.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical(df.collect(), df.columns) == canonical(result.fetchall(), names)
