"""Lookup index and curve: lookups read candidate files only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from widelines.plans import clustering, file_index, layouts, sinks
from widelines.plans.file_index import MAX_PROBE_KEYS, build_file_index, candidate_files, lookup, lookup_values

FILES = 256


@pytest.fixture(scope="module")
def stored(spark):
    """60,000 orders of 1,000 customers in 40 states over three years, along the curve and (by chance) in 32 files."""
    from widelines.session import scratch_path

    root = scratch_path(spark, "index-test")
    rows = (spark.range(60_000).select(
        F.col("id").alias("order_id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("customer_id"),
        F.concat(F.lit("INV-"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(60_000)).cast("string"), 8, "0")).alias("invoice_number"))
        .withColumn("state", F.when(F.col("customer_id") % 50 != 7, F.format_string("State %02d", F.col("customer_id") % 40)))
        .withColumn("city", F.concat(F.lit("City "), F.col("customer_id") % 200))
        .withColumn("order_date", (F.lit(dt.datetime(2020, 1, 1)) + F.make_dt_interval(F.pmod(F.xxhash64("order_id", F.lit(1)), F.lit(1000)).cast("int"))).cast("timestamp_ntz")))
    rows.repartition(8).write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    clustering.write_clustered(raw, root, "sales_order_fact", files=FILES)
    plain = sinks.write_version(raw.repartition(32, "order_id"), root, "plain")
    build_file_index(spark, root, "plain", plain.version, ("order_id", "invoice_number"), ("invoice_number",))
    return root, raw


def _check(found, want, most):
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.select(*found.columns).collect()))
    assert len(found.inputFiles()) <= most


def test_lookups_on_each_curve_column_read_less_than_a_quarter_of_the_files(spark, stored):
    root, raw = stored
    name = clustering.clustered_name("sales_order_fact")
    assert len(sinks.read_current(spark, root, name).inputFiles()) >= 32
    customers = raw.where("customer_id = 123 or customer_id is null")
    _check(lookup(spark, root, name, "customer_id", customers), raw.where("customer_id = 123"), FILES // 4 - 1)
    _check(lookup(spark, root, name, "state", ["State 03"]), raw.where("state = 'State 03'"), FILES // 4 - 1)
    _check(lookup_values(spark, root, name, {"state": ["State 03"], "city": ["City 43"]}),
           raw.where("state = 'State 03' and city = 'City 43'"), FILES // 4 - 1)


def test_sketch_finds_the_files_of_unordered_keys(spark, stored):
    root, raw = stored
    version = sinks.current_version(spark, root, "plain")
    for invoice in ("INV-00000007", "INV-00031415"):
        files = candidate_files(spark, root, "plain", version, "invoice_number", [invoice])
        assert 1 <= len(files) <= 4  # ranges of chance order exclude none of 32
        _check(lookup(spark, root, "plain", "invoice_number", [invoice, None]), raw.where(F.col("invoice_number") == invoice), 4)
    every = [r[0] for r in raw.select("invoice_number").limit(300).collect()]
    _check(lookup(spark, root, "plain", "invoice_number", every), raw.where(F.col("invoice_number").isin(every)), 32)


def test_missing_keys_and_large_probes(spark, stored):
    root, raw = stored
    assert lookup(spark, root, "plain", "invoice_number", ["none"]).collect() == []
    assert lookup(spark, root, "plain", "order_id", []).collect() == []
    many = raw.where(F.col("order_id") < 2 * MAX_PROBE_KEYS)
    assert lookup(spark, root, "plain", "order_id", many).count() == 2 * MAX_PROBE_KEYS


def test_keys_are_pushed_into_the_scan(spark, stored):
    root, _ = stored
    plan = lookup(spark, root, "plain", "order_id", [5, 6])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(order_id, [5,6])]" in plan


def test_ranks_and_curve(spark):
    df = spark.createDataFrame([(None,), *((i,) for i in range(8))], "x long")
    got = [r[0] for r in df.select(clustering.rank(F.col("x"), [1, 3, 5], 2)).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 3]
    pair = spark.createDataFrame([(0b101, 0b011)], "a long, b long")
    assert pair.select(clustering.curve_value([F.col("a"), F.col("b")], 3)).first()[0] == 0b100111
    assert pair.select(clustering.curve_value([F.col("a"), F.col("b")], 3, [1, 2])).first()[0] == 0b100111
    assert pair.select(clustering.curve_value([F.col("b"), F.col("a")], 3, [1, 2])).first()[0] == 0b011101
    texts = spark.createDataFrame([("NATION_1",), ("NATION_10",), ("NATION_2",), (None,)], "t string")
    key = clustering.sort_keys(texts, ("t",))["t"]
    assert [r[0] for r in texts.orderBy(key.asc_nulls_first()).collect()] == [None, "NATION_1", "NATION_10", "NATION_2"]


def test_layouts_have_an_index(spark):
    assert set(layouts.INDEX_RANGES) == set(layouts.LAYOUTS) == set(layouts.INDEX_SKETCHES)


def test_a_file_and_bucket_are_one_number(spark):
    """The bitmaps are built by sorting: a value takes a few longs there, not its file's path."""
    df = spark.createDataFrame([("a", 0), ("a", 5), ("b", 5)], "file string, bucket int")
    at = [r[0] for r in df.select(file_index._block("file", F.col("bucket"))).collect()]
    assert at[1] - at[0] == 5 and at[0] % (1 << file_index.BUCKET_BITS) == 0 and at[2] != at[1]


def test_files_without_values_and_equal_files(spark, scratch):
    rows = spark.createDataFrame([(1, "x"), (2, None), (3, "x"), (4, "y")], "order_id long, t string")
    done = sinks.write_version(rows.repartitionByRange(4, "order_id"), scratch, "t")
    build_file_index(spark, scratch, "t", done.version, ("order_id",), ("t",))
    assert [len(candidate_files(spark, scratch, "t", done.version, "t", [k])) for k in ("x", "y", "z")] == [2, 1, 0]


def test_rank_stays_small(spark):
    """A tree of 63 comparisons a column makes methods that the JVM does not compile."""
    df = spark.range(1).select(clustering.rank(F.col("id"), list(range(1, 64)), 6))
    assert df._jdf.queryExecution().analyzed().toString().count(">") < 8


def test_more_bytes_more_curve_files(monkeypatch):
    for size, files in ((0, 64), (64 * clustering.FILE_BYTES, 64), (1000 * clustering.FILE_BYTES + 1, 1001)):
        monkeypatch.setattr(clustering, "file_bytes", lambda df, size=size: size)
        assert clustering.curve_files(None) == files


def test_ranges_of_texts_are_sorted_by_a_number(spark, scratch, monkeypatch):
    """The sort holds every row of a task: without its file's path."""
    plans = []
    group_by = type(spark.range(1)).groupBy

    class Seen:
        def __init__(self, grouped):
            self.grouped = grouped

        def agg(self, *columns):
            out = self.grouped.agg(*columns)
            plans.append(out.schema.fields[0].dataType.typeName())
            return out

    rows = spark.createDataFrame([(1, "x"), (2, None)], "order_id long, t string")
    done = sinks.write_version(rows.repartition(1), scratch, "t")
    monkeypatch.setattr(type(rows), "groupBy", lambda df, *c: Seen(group_by(df, *c)))
    out = build_file_index(spark, scratch, "t", done.version, ("order_id", "t"), ("t",))
    assert plans[0] == "long"
    found = spark.read.parquet(f"{out}/ranges").select("rows", "lo_t", "hi_t", "lo_order_id", "hi_order_id", "distinct_t").collect()
    assert [tuple(r) for r in found] == [(2, "x", "x", 1, 2, 1)]
