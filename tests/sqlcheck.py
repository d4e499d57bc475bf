"""Spark queries against their SQL twins on the smallest tables."""

import collections
import math
from pathlib import Path

import duckdb
import pytest

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    if not Path(BASE).exists():
        pytest.skip("the shared tables are not here")
    con = duckdb.connect()
    for p in Path(BASE).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, (str, bool, int)) else float(v) if hasattr(v, "as_integer_ratio") else v


def compare(spark, duck, query, sql):
    df = query(spark, BASE)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(plain(x) for x in r) for r in df.select(*(f"`{c}`" for c in cols)).collect())
    res = duck.execute(sql)
    names = [d[0] for d in res.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    assert [names[i] for i in at] == cols
    want = collections.Counter(tuple(plain(r[i]) for i in at) for r in res.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
