"""Each registered query against its DuckDB equivalent on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from lociq.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    """Integers exact, other numbers to five digits."""
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, (float, Decimal)):
        return str(int(v)) if v == int(v) else f"{float(v):.5g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    found = sorted(tuple(map(plain, r)) for r in df.select(*(f"`{c}`" for c in cols)).collect())
    result = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert cols == sorted(names)
    at = [names.index(c) for c in cols]
    want = sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
    assert found == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
