"""Every registered query equals its DuckDB oracle (the driver's correctness gate)."""

import duckdb
import pytest

from conftest import SMALL
from tools.check_oracle import TABLES, digest

import __spark_entry__ as entry_mod

from tessera.plans.registry import ORACLE_SQL as ORACLES, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert len(got) == len(want)
    assert digest(got_cols, got)[0] == digest(want_cols, want)[0]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["source", "n_rows", "n_json", "custkey_sum", "n_partitions"]
    assert df.count() == 3
