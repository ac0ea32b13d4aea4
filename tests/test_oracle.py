"""Every query against DuckDB on the given tables: rows, column names and types, values."""

from __future__ import annotations

import os
from collections import Counter
from glob import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DATE": "date"}


def spark_type(duck: str) -> str:
    return TYPES.get(duck, duck.lower())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        connection.execute(
            f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')"
        )
    return connection


def test_every_ledger_query_has_an_oracle():
    """What SQL cannot express, in the optional subpackage, is tested beside its operators."""
    optional, optional_sql = contract._training_data()
    assert optional_sql.keys() <= optional.keys()
    assert contract.queries().keys() - optional.keys() == (
        contract.oracle_sql().keys() - optional_sql.keys()
    )


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR)
    theirs = duck.execute(contract.oracle_sql()[name])
    columns = {d[0]: spark_type(str(d[1])) for d in theirs.description}
    assert {f.name: f.dataType.simpleString() for f in ours.schema.fields} == columns
    order = sorted(columns)
    expected = [dict(zip([d[0] for d in theirs.description], row)) for row in theirs.fetchall()]
    assert Counter(tuple(r[c] for c in order) for r in ours.collect()) == Counter(
        tuple(r[c] for c in order) for r in expected
    )
