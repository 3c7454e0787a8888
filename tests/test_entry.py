"""Driver contract: entry(), queries() and oracle_sql() agree (run at sf0.001)."""

import sys

import duckdb
import pytest

from paths import SF001

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0] + "/tools")
import __spark_entry__ as se  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

QUERIES = se.queries()
ORACLES = se.oracle_sql()


def test_entry(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert df.columns[:2] == ["table_name", "file_name"]
    assert sum(r.total_records_loaded_count for r in rows) == 5828


def test_every_table_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert all(name in ORACLES for name in QUERIES if name.startswith(("fw_", "mask_")))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
