"""Every registered query runs, and equals its SQL where there is one."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    v = float(v) if isinstance(v, Decimal) else v
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v + 0.0 if isinstance(v, float) else v)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("op") and n != "pipeline"))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert rows == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())


def test_points_of_long_grids(spark, tmp_path):
    """Rows 0, just before, at and past both poles, and the last ones of 60 times sf0.1."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW small AS SELECT * FROM '{SMALL}/orders.parquet'")
    con.execute("CREATE TABLE orders AS SELECT o_orderkey + 125 * first AS o_orderkey, * EXCLUDE (o_orderkey) FROM small, (SELECT unnest([0, 2444, 7188, 11444, 20444, 71988]) AS first)")
    con.execute(f"COPY orders TO '{tmp_path}/orders.parquet'")
    want = con.execute(ORACLES["p21_reproject_points"]).fetchall()
    found = QUERIES["p21_reproject_points"](spark, str(tmp_path)).select("r", "c", "lon", "lat").collect()
    assert len(want) == 9000 and sorted(tuple(map(plain, r)) for r in found) == sorted(tuple(map(plain, r)) for r in want)


def test_registry():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
