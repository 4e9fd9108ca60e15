"""Every registered query against its DuckDB oracle, on the smallest test tables.

The comparison mirrors the driver's: same column names, same row count and
the same multiset of rows (values rendered canonically, order ignored).
"""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from widelines import registry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _canon(v):
    if v is None:
        return "\\N"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (decimal.Decimal, int, float)):
        d = decimal.Decimal(str(v)) if isinstance(v, float) else decimal.Decimal(v)
        return format(d.normalize(), "f")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "order_id"


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = registry.QUERIES[key](spark, SF)
    cols, rows = df.columns, df.collect()
    cur = duck.execute(registry.ORACLE[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(cols, rows) == _rows(ocols, orows)
