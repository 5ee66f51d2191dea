"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as contract

# The training-data queries have their own tests beside their package.
QUERIES = {n: q for n, q in contract.queries().items() if n != "pipeline" and not re.match(r"op\d", n)}
ORACLE = {n: q for n, q in contract.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{sf_dir}/events.parquet'")
    return connection


def _sorted(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]

    def value(x):
        return f"{x + 0.0:.6f}" if isinstance(x, float) else str(x)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, tables, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    result = tables.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _sorted([tuple(r) for r in frame.collect()], frame.columns) == _sorted(
        result.fetchall(), columns
    )


def test_entry(spark):
    assert contract.entry(spark).count() == 15
