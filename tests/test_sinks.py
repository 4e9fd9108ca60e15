"""Versioned writes, publication, CSV round trips."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.plans import sinks


def _read_parts(path):
    """Concatenated text of the CSV part files (local file system in tests)."""
    path = path.removeprefix("file:")
    return "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path))
                   if f.endswith(".csv"))

CSV_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("amount", T.DecimalType(12, 2)),
    T.StructField("ts", T.TimestampNTZType()),
])


def test_csv_roundtrip_keeps_awkward_text(spark, scratch):
    rows = [(1, None, Decimal("1.00"), dt.datetime(2025, 1, 1, 8, 0)),
            (2, "", Decimal("-2.50"), dt.datetime(2025, 1, 1, 8, 0, 0, 120000)),
            (3, 'a"b', None, None),
            (4, "n,l\nnext", Decimal("3.10"), dt.datetime(2024, 2, 29, 23, 59, 59)),
            (5, " x ", Decimal("0.00"), dt.datetime(2025, 6, 1)),
            (6, "back\\slash", Decimal("9.99"), dt.datetime(2025, 6, 1))]
    df = spark.createDataFrame(rows, CSV_SCHEMA)
    ok, path = sinks.export_csv(df, scratch, "t", dt.date(2025, 12, 10))
    assert ok and path.endswith("t_20251210.csv")
    back = sinks.read_csv(spark, path, CSV_SCHEMA)
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_text_is_copy_compatible(spark, scratch):
    df = spark.createDataFrame([(1, None, Decimal("1.50"), dt.datetime(2025, 1, 2, 3, 4, 5)),
                                (2, "", None, None), (3, 'say "hi"', None, None)], CSV_SCHEMA)
    ok, path = sinks.export_csv(df.coalesce(1), scratch, "t", dt.date(2025, 1, 1))
    lines = _read_parts(path).splitlines()
    assert lines[0] == "id,name,amount,ts"
    assert lines[1] == "1,,1.50,2025-01-02 03:04:05.000000"  # NULL is empty, space in ts
    assert lines[2] == '2,"",,'                                # '' is quoted
    assert lines[3] == '3,"say ""hi""",,'                       # quotes doubled


def test_export_failure_returns_false(spark, scratch):
    df = spark.range(3).withColumn("bad", F.array(F.lit(1)))  # CSV cannot hold arrays
    assert sinks.export_csv(df, scratch, "bad", dt.date(2025, 1, 1)) == (False, "")


def test_versions_publish_and_failed_build_keeps_old(spark, scratch):
    v1 = sinks.write_version(spark.range(5), scratch, "t")
    assert v1.row_count == 5
    assert sinks.read_current(spark, scratch, "t").count() == 5
    broken = spark.range(5).withColumn("x", F.expr("raise_error('boom')"))
    with pytest.raises(Exception):
        sinks.write_version(broken, scratch, "t")
    assert sinks.current_version(spark, scratch, "t") == v1.version
    v2 = sinks.write_version(spark.range(7), scratch, "t")
    assert sinks.read_current(spark, scratch, "t").count() == 7 and v2.version > v1.version


def test_unpublished_version_is_invisible_until_published(spark, scratch):
    v1 = sinks.write_version(spark.range(2), scratch, "a")
    v2 = sinks.write_version(spark.range(3), scratch, "a", publish=False)
    sinks.write_version(spark.range(4), scratch, "b", version=v2.version, publish=False)
    assert sinks.current_version(spark, scratch, "a") == v1.version
    sinks.publish_versions(spark, scratch, {"a": v2.version, "b": v2.version})
    assert sinks.read_current(spark, scratch, "a").count() == 3
    assert sinks.read_current(spark, scratch, "b").count() == 4


def test_original_csv_literal(spark, scratch):
    """The original job's own export test: id,name,amount with 2 rows, dated name."""
    schema = "id int, name string, amount decimal(10,2)"
    df = spark.createDataFrame([(1, "Test", Decimal("100.50")), (2, "Test2", Decimal("200.75"))],
                               schema)
    ok, path = sinks.export_csv(df.coalesce(1), scratch, "test_table", dt.date(2025, 12, 10))
    assert ok and os.path.basename(path) == "test_table_20251210.csv"
    assert _read_parts(path) == "id,name,amount\n1,Test,100.50\n2,Test2,200.75\n"


def test_concurrent_publishers(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    def build(i):
        return sinks.write_version(spark.range(i + 1), scratch, f"t{i}")

    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(build, range(4)))
    for i, r in enumerate(results):
        assert sinks.current_version(spark, scratch, f"t{i}") == r.version
        assert sinks.read_current(spark, scratch, f"t{i}").count() == i + 1
