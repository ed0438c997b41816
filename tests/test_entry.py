"""Driver contract: entry(), queries() and oracle_sql() at the smallest scale."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "cost_mom_change_pct" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    assert set(oracle_sql()) <= set(queries())
    own = {k for k in queries() if not k.startswith("op") and k != "pipeline"}
    assert own - set(oracle_sql()) == {"landing_file_audit"}


def _duck():
    con = duckdb.connect()
    for t in ("events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


SPARK_TO_DUCK = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("key", sorted(k for k in oracle_sql() if not re.match(r"op\d+_|pipeline", k)))
def test_query_matches_oracle(spark, key):
    df = queries()[key](spark, SF)
    con = _duck()
    res = con.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    otypes = {c: str(t) for c, t in zip(ocols, con.sql(oracle_sql()[key]).types)}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == otypes
    order = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    idx = [ocols.index(c) for c in order]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
