"""Every registered query against its independent SQL on the smallest tables."""

import glob
import os
from datetime import datetime, timezone

import duckdb
import pytest

from quillmark.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def cell(v):
    if isinstance(v, datetime) and v.tzinfo:
        v = v.astimezone(timezone.utc).replace(tzinfo=None)
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = sorted(tuple(cell(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert rows
    if name in ORACLES:
        got = duck.execute(ORACLES[name])
        names = [c[0] for c in got.description]
        assert sorted(names) == sorted(df.columns)
        at = [names.index(c) for c in sorted(names)]
        assert rows == sorted(tuple(cell(r[i]) for i in at) for r in got.fetchall())
