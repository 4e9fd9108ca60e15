"""Semi and anti joins with many keys: the rows of the plain joins, most of them not shuffled."""

import pytest
from pyspark.sql import functions as F

from widelines.functions import keysets
from widelines.functions.keysets import KeySet


@pytest.fixture(params=["long", "string"])
def sets(request, spark):
    """20,000 rows with each key twice and NULLs, and 300 of their keys with others."""
    kind = request.param
    rows = spark.range(20_000).select(F.when(F.col("id") % 100 != 0, F.floor(F.col("id") / 2)).cast(kind).alias("k"), F.col("id").alias("v"))
    keys = spark.range(300).select((F.col("id") * 37 + 5).cast(kind).alias("k")).union(spark.createDataFrame([(None,)], f"k {kind}"))
    return rows, keys


def _values(df):
    return sorted(r["v"] for r in df.collect())


def test_key_sets_equal_plain_joins(sets, monkeypatch):
    rows, keys = sets
    known = keys.where("k is not null")
    for bitmaps in (4096, 1):
        monkeypatch.setattr(keysets, "MAX_BITMAPS", bitmaps)
        found = KeySet(keys, "k", max_broadcast_rows=10)
        assert found.bitmaps is not None and KeySet(keys, "k").bitmaps is None
        assert _values(found.semi(rows)) == _values(rows.join(known, "k", "left_semi")) == _values(KeySet(keys, "k").semi(rows)) != []
        assert _values(found.anti(rows)) == _values(rows.join(known, "k", "left_anti")) == _values(KeySet(keys, "k").anti(rows))


def test_key_sets_shuffle_few_rows(sets):
    rows, keys = sets
    marked = KeySet(keys, "k", max_broadcast_rows=10)._marked(rows)
    assert 500 < marked.where("_maybe").count() < 2500  # of 20,000; all were shuffled before
    other = rows.withColumn("k", F.col("k").cast("double"))
    assert KeySet(keys, "k", max_broadcast_rows=10)._marked(other) is None  # equal values of other types hash differently
