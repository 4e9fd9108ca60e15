"""Bucketed order-keyed sources: same results, no shuffle on order_id."""

from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items
from widelines.sources.bucketed import bucketed_sources
from widelines.sources.fixtures import fixture_sources

SF = "/root/testdata/sf0.001"


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_fact_is_shuffle_free_on_order_id(spark, scratch):
    src = fixture_sources(spark, SF)
    bsrc = bucketed_sources(spark, src, scratch, num_buckets=4)
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")  # joins by key
    try:
        fact = sales_order_fact(bsrc)
        fact.collect()
        plan = _physical(fact)
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning(order_id" not in plan
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    ref = sales_order_fact(src)
    assert fact.exceptAll(ref).count() == 0 and ref.exceptAll(fact).count() == 0


def test_bucketed_line_items_equal(spark, scratch):
    src = fixture_sources(spark, SF)
    bsrc = bucketed_sources(spark, src, scratch, num_buckets=4)
    lines = sales_order_line_items(bsrc)
    ref = sales_order_line_items(src)
    assert lines.exceptAll(ref).count() == 0 and ref.exceptAll(lines).count() == 0
