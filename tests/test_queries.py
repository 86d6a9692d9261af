"""Every query of the library that has SQL gives the same rows as DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from spanledger import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in registry.SQL:
        assert rows
        return
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(registry.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert rows == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
