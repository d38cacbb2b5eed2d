"""Every query against its SQL twin in DuckDB."""

import duckdb
import pytest
from landsurvey.plans.oracle import SQL
from landsurvey.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_twin_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    rows = con.execute(SQL[name])
    at = [[d[0] for d in rows.description].index(c) for c in names]
    assert len(at) == len(rows.description)
    want = sorted(repr(tuple(r[i] for i in at)) for r in rows.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want


def test_block_means_do_not_follow_the_files(spark, con, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    orders.orderBy(orders.o_orderkey.desc()).repartition(5, "o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    other = con.cursor()
    other.execute("SET threads = 1")
    other.execute("CREATE TEMP VIEW orders AS SELECT * FROM '/root/testdata/sf0.01/orders.parquet'")
    want = sorted(other.execute(f"SELECT tile_x, tile_y, br, bc, z FROM ({SQL['block_downsample']})").fetchall(), key=repr)
    other.execute("RESET threads")
    got = QUERIES["block_downsample"](spark, str(tmp_path)).select("tile_x", "tile_y", "br", "bc", "z").collect()
    assert sorted(map(tuple, got), key=repr) == want
