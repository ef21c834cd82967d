"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "-"
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def library(entries):
    """What this library registers without its text operators, which have tests of their own."""
    text = {name for module in contract._text_modules() for name in module.QUERIES}
    return {name: entry for name, entry in entries.items() if name not in text}


def test_every_query_has_sql():
    assert set(library(contract.queries())) == set(library(contract.oracle_sql()))


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and sum(row["orders"] for row in rows) > 0


@pytest.mark.parametrize("name", sorted(library(contract.queries())))
def test_matches_sql(spark, con, name):
    ours = contract.queries()[name](spark, SF)
    result = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(ours.columns) == sorted(names)
    assert {c: TYPES.get(t) for c, t in ours.dtypes} == {c[0]: str(c[1]) for c in result.description}
    assert canonical(ours.columns, [tuple(r) for r in ours.collect()]) == canonical(names, result.fetchall())
