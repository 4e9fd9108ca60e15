"""Incremental refresh equals a full rebuild (inserts, updates, deletes)."""

import datetime as dt

from builders import customer, make_sources, order, part, svc
from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items
from widelines.plans import layouts
from widelines.streaming.change_feed import CHANGE_SCHEMA, start_change_feed
from widelines.streaming.incremental import (changed_since, refresh_fact, refresh_line_items,
                                             snapshot_before)

OLD = dt.datetime(2025, 1, 1)
NEW = dt.datetime(2025, 3, 1)
CUT = dt.datetime(2025, 2, 1)


def _before(spark):
    return make_sources(spark, customers=[customer(1), customer(2)],
                        orders=[order(1, 1, when=OLD), order(2, 2, when=OLD),
                                order(3, 1, when=OLD)],
                        parts=[part("p1", 1, 2), part("p2", 2, 1), part("p3", 3, 5)],
                        services=[svc("s1", 1, 1)])


def _after(spark):
    # order 1 updated (new line), order 3 deleted, order 4 inserted; order 2 unchanged
    return make_sources(spark, customers=[customer(1), customer(2)],
                        orders=[order(1, 1, when=NEW), order(2, 2, when=OLD),
                                order(4, 2, when=NEW)],
                        parts=[part("p1", 1, 2), part("p1b", 1, 4), part("p2", 2, 1),
                               part("p4", 4, 3)],
                        services=[svc("s1", 1, 1), svc("s4", 4, 2)])


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_refresh_equals_full_rebuild(spark):
    before, after = _before(spark), _after(spark)
    changed = changed_since(after, CUT)
    fact = refresh_fact(after, sales_order_fact(before), changed)
    assert _same(fact, sales_order_fact(after))
    lines = refresh_line_items(after, sales_order_line_items(before), changed)
    assert _same(lines, sales_order_line_items(after))


def test_snapshot_then_refresh(spark):
    after = _after(spark)
    initial = sales_order_fact(snapshot_before(after, CUT))
    assert {r.order_id for r in initial.collect()} == {2}
    assert _same(refresh_fact(after, initial, changed_since(after, CUT)), sales_order_fact(after))


def test_change_feed_stream_applies_changes(spark, scratch):
    before, after = _before(spark), _after(spark)
    root = f"{scratch}/tables"
    layouts.write_layout(sales_order_fact(before), root, "sales_order_fact")
    layouts.write_layout(sales_order_line_items(before), root, "sales_order_line_items")
    feed = f"{scratch}/feed"
    spark.createDataFrame([(1,), (3,), (4,)], CHANGE_SCHEMA).write.parquet(feed)
    q = start_change_feed(spark, feed, lambda: after, root, f"{scratch}/stream-ckpt")
    q.awaitTermination(120)
    fact = layouts.read_layout(spark, root, "sales_order_fact").drop("order_year", "order_month")
    assert _same(fact.select(*sales_order_fact(after).columns), sales_order_fact(after))
