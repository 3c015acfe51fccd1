"""Every registered query with an oracle against SQL on an independent engine."""

import importlib.util
from pathlib import Path

import duckdb
import pytest
from conftest import ROOT, SMALL

from __spark_entry__ import entry, oracle_sql, queries

spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check_oracle = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check_oracle)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_matches_oracle(spark, duck, key):
    mine = queries()[key](spark, SMALL)
    cursor = duck.execute(oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    assert sorted(mine.columns) == sorted(names)
    got = check_oracle.normal(mine.columns, [tuple(r) for r in mine.collect()])
    assert got == check_oracle.normal(names, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 1000
