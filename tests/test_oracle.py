"""Every registered query with SQL equals that SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from conftest import FOLDER

import __spark_entry__ as contract

KINDS = {"double": "DOUBLE", "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def comparable(rows, order):
    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "NULL"
        return repr(value + 0.0) if isinstance(value, float) else str(value)

    return sorted(tuple(cell(row[k]) for k in order) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, folder, engine, name):
    df = contract.queries()[name](spark, folder)
    relation = engine.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    names = sorted(df.columns)
    ours = comparable([tuple(r) for r in df.collect()], [df.columns.index(c) for c in names])
    theirs = comparable(relation.fetchall(), [relation.columns.index(c) for c in names])
    assert ours == theirs


def test_every_query_is_registered_once():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["City", "mean_aqi"]
    assert result.count() == 10
