"""Layouts: lookups prune partitions and push filters into the Parquet scan."""

import datetime as dt

from pyspark.sql import functions as F

from widelines import registry
from widelines.operators import access
from widelines.operators.fact import sales_order_fact
from widelines.plans import layouts
from widelines.sources.fixtures import fixture_sources

SF = "/root/testdata/sf0.001"


def _laid(spark, scratch):
    src = fixture_sources(spark, SF)
    layouts.write_layout(sales_order_fact(src), scratch, "sales_order_fact")
    return src, layouts.read_layout(spark, scratch, "sales_order_fact")


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_prunes_partitions(spark, scratch):
    src, fact = _laid(spark, scratch)
    lo, hi = dt.date(1996, 3, 1), dt.date(1996, 5, 1)
    got = access.by_date_range(fact, lo, hi)
    plan = _physical(got)
    assert "PartitionFilters: [" in plan and "order_year" in plan.split("PartitionFilters")[1]
    brute = sales_order_fact(src).where(
        (F.col("order_date") >= F.lit("1996-03-01").cast("timestamp_ntz"))
        & (F.col("order_date") < F.lit("1996-05-01").cast("timestamp_ntz")))
    assert got.count() == brute.count() > 0


def test_point_lookups_push_filters(spark, scratch):
    _, fact = _laid(spark, scratch)
    some = fact.select("invoice_number", "order_id").first()
    got = access.by_values(fact, "invoice_number", [some.invoice_number])
    assert "PushedFilters: [IsNotNull(invoice_number), In(invoice_number" in _physical(got) or \
        "EqualTo(invoice_number" in _physical(got)
    assert [r.order_id for r in got.collect()] == [some.order_id]


def test_probe_lookup_equals_filter(spark, scratch):
    src, fact = _laid(spark, scratch)
    probe = src.customers.where(F.col("phone").isNull())
    got = access.by_probe(fact, probe, "customer_id")
    ids = [r.customer_id for r in probe.collect()]
    assert got.count() == fact.where(F.col("customer_id").isin(ids)).count() > 0


def test_layout_files_sorted_by_key(spark, scratch):
    _, fact = _laid(spark, scratch)
    per_file = (fact.withColumn("f", F.input_file_name())
                .groupBy("f").agg(F.min("order_id").alias("lo"), F.max("order_id").alias("hi"),
                                  F.countDistinct("order_year", "order_month").alias("parts")))
    assert per_file.where("parts > 1").count() == 0  # one month per file


def test_a_lookup_stores_only_the_tables_it_reads(spark, monkeypatch):
    made = []
    write = layouts.write_layout
    monkeypatch.setattr(registry, "_LAYOUT_ROOTS", {})
    monkeypatch.setattr(registry.layouts, "write_layout", lambda df, root, name, *a, **kw: made.append(name) or write(df, root, name, *a, **kw))
    for _ in range(2):  # the second lookup finds what the first one stored
        assert registry.QUERIES["fact_by_status"](spark, SF).count() > 0
    assert made == ["sales_order_fact"]
    registry.QUERIES["catalog_by_service"](spark, SF).count()
    assert made == ["sales_order_fact", "service_parts_catalog"]
