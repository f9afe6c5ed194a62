"""Every registered query of the document operators against its DuckDB SQL, on the smallest tables."""

import os

import duckdb
import pytest

from paperloom.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    one = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)[:19] if hasattr(x, "isoformat") else str(x)
    return sorted(tuple(one(r[i]) for i in order) for r in rows), [names[i] for i in order]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, duck, name):
    q = catalog.queries()[name]
    df = q(spark, sf)
    got = plain(df.collect(), df.columns)
    assert got[0]
    if q.sql:
        r = duck.execute(q.sql)
        names = [c[0] for c in r.description]
        assert got == plain(r.fetchall(), names)
