"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
import __spark_entry__ as entry  # noqa: E402
from check_oracle import key_of, norm  # noqa: E402
from shoreline.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(entry._REGISTERED))
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    scols = df.columns
    srows = [tuple(norm(x) for x in r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    assert sql is not None, f"{key} has no oracle"
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
    assert sorted(scols) == sorted(dcols)
    so = sorted(range(len(scols)), key=lambda i: scols[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    assert sorted((tuple(r[i] for i in so) for r in srows), key=key_of) == \
        sorted((tuple(r[i] for i in do) for r in drows), key=key_of)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["id", "product", "price", "stock", "updated_at"]
