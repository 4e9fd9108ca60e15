"""Refresh by partitions: new folders for what changed, one record for all tables, rollups moved on by deltas."""

import datetime as dt
import json
import re

from builders import customer, make_sources, order, part, svc
from widelines.operators import reports
from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items
from widelines.plans import layouts, publish_log, sinks
from widelines.schemas import WIDE
from widelines.streaming import rollups
from widelines.streaming.incremental import ORDER_TABLES, ROLLUPS, refresh_partitions, write_rollups

JAN, FEB, MAR, APR = (dt.datetime(2025, m, 10) for m in (1, 2, 3, 4))


def _before(spark):
    return make_sources(
        spark, customers=[customer(1), customer(2)],
        orders=[order(1, 1, when=JAN), order(2, 2, when=FEB), order(3, 1, when=MAR), order(4, 1, when=APR), order(5, 2, when=APR),
                (6, 2, None, *order(6, 2)[3:]), (7, 1, None, *order(7, 1)[3:])],
        parts=[part("p1", 1, 2), part("p2", 2, 1), part("p3", 3, 5), part("p4", 4, 1), part("p6", 6, 2), part("p7", 7, 2)],
        services=[svc("s1", 1, 1), svc("s2", 2, 1), svc("s5", 5, 3)])


def _after(spark):
    """Order 1 moved from January to February, 3 deleted (March ends empty), 5 lost its last service line, 6 got a date,
    8 is new and has none; 2, 4 and 7 (undated) as they were."""
    return make_sources(
        spark, customers=[customer(1), customer(2)],
        orders=[order(1, 1, when=FEB), order(2, 2, when=FEB), order(4, 1, when=APR), order(5, 2, when=APR), order(6, 2, when=APR),
                (7, 1, None, *order(7, 1)[3:]), (8, 2, None, *order(8, 2)[3:])],
        parts=[part("p1", 1, 2), part("p2", 2, 1), part("p4", 4, 1), part("p6", 6, 2), part("p7", 7, 2), part("p8", 8, 1)],
        services=[svc("s1", 1, 1), svc("s2", 2, 1)])


CHANGED = [(1,), (3,), (5,), (6,), (8,), (1,), (None,)]


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _load(spark, root, src):
    for name, build in ORDER_TABLES.items():
        layouts.write_layout(build(src), root, name)
    write_rollups(sales_order_fact(src), root)


def test_partition_refresh_equals_full(spark, scratch):
    after = _after(spark)
    _load(spark, scratch, _before(spark))
    store = publish_log.Store(spark, scratch)
    old = {name: layouts.live_folders(store, name) for name in ORDER_TABLES}
    records = len(publish_log._sequence(store, ".json"))
    changed = refresh_partitions(spark, after, scratch, spark.createDataFrame(CHANGED, "order_id long"))

    fact = sinks.read_current(spark, scratch, "sales_order_fact", WIDE["sales_order_fact"])
    lines = sinks.read_current(spark, scratch, "sales_order_line_items", WIDE["sales_order_line_items"])
    assert _same(fact, sales_order_fact(after)) and _same(lines, sales_order_line_items(after))

    # one record switches both tables and the rollups; untouched partitions keep their folders
    assert len(publish_log._sequence(store, ".json")) == records + 1
    last = max(publish_log._sequence(store, ".json"))
    assert {e["table"] for e in json.loads(store.read(f"_publish/{last:020d}.json"))} == {*ORDER_TABLES, ROLLUPS}
    new = layouts.live_folders(store, "sales_order_fact")
    none = "order_year=__HIVE_DEFAULT_PARTITION__/order_month=__HIVE_DEFAULT_PARTITION__"
    assert set(changed["sales_order_fact"]) == {f"order_year=2025/order_month={m}" for m in (1, 2, 3, 4)} | {none}
    assert "order_year=2025/order_month=3" not in new and "order_year=2025/order_month=1" not in new
    services = layouts.live_folders(store, "sales_order_line_items")
    april = "line_item_type=SERVICE/order_year=2025/order_month=4"
    assert april in old["sales_order_line_items"] and april not in services
    kept = "line_item_type=SERVICE/order_year=2025/order_month=2"
    assert services[kept] != old["sales_order_line_items"][kept]  # order 1 moved in

    for unit, report in (("day", reports.daily_rollup), ("month", reports.monthly_rollup)):
        state = sinks.read_current(spark, scratch, ROLLUPS)
        assert _same(rollups.rollup(state, unit), report(sales_order_fact(after)))


def test_refresh_reads_no_unchanged_partition_for_the_rollups(spark, scratch):
    """A change in April leaves the folders of other months as they are, and a second refresh starts from the first."""
    before, after = _before(spark), _after(spark)
    _load(spark, scratch, before)
    store = publish_log.Store(spark, scratch)
    old = layouts.live_folders(store, "sales_order_fact")
    one = before.with_tables(sales_order=before.sales_order.where("order_id != 4"))
    changed = refresh_partitions(spark, one, scratch, spark.createDataFrame([(4,)], "order_id long"))
    new = layouts.live_folders(store, "sales_order_fact")
    assert changed["sales_order_fact"] == ["order_year=2025/order_month=4"]
    assert {p for p in old if new.get(p) != old[p]} == {"order_year=2025/order_month=4"}
    refresh_partitions(spark, after, scratch, spark.createDataFrame([*CHANGED, (4,)], "order_id long"))
    assert _same(sinks.read_current(spark, scratch, "sales_order_fact", WIDE["sales_order_fact"]), sales_order_fact(after))
    assert _same(rollups.rollup(sinks.read_current(spark, scratch, ROLLUPS), "day"), reports.daily_rollup(sales_order_fact(after)))


def test_all_orders_deleted(spark, scratch):
    before = _before(spark)
    _load(spark, scratch, before)
    none = make_sources(spark, customers=[customer(1), customer(2)])
    refresh_partitions(spark, none, scratch, before.sales_order.select("order_id"))
    for name in ORDER_TABLES:
        assert sinks.read_current(spark, scratch, name, WIDE[name]).count() == 0
    assert sinks.read_current(spark, scratch, ROLLUPS).count() == 0


def test_delta_plan_scans_touched_folders_only(spark, scratch):
    _load(spark, scratch, _before(spark))
    folders = layouts.live_folders(publish_log.Store(spark, scratch), "sales_order_fact")
    touched = folders["order_year=2025/order_month=4"]
    rows = sinks.read_folders(spark, scratch, "sales_order_fact", [touched], layouts.stored_schema("sales_order_fact"))
    moved = rollups.apply_delta(sinks.read_current(spark, scratch, ROLLUPS), rows, rows)
    files = [f for f in moved.inputFiles() if "sales_order_fact" in f]
    assert files and all(re.search("order_month=4/", f) for f in files)
    assert _same(moved, sinks.read_current(spark, scratch, ROLLUPS))


def test_recomputed_rows_are_written_once(spark, scratch, monkeypatch):
    """The new version is the only place that a refresh writes wide rows to: none lie in a scratch table first."""
    from widelines.streaming import incremental

    _load(spark, scratch, _before(spark))
    made = []
    monkeypatch.setattr(incremental, "scratch_path", lambda session, label: made.append(label) or f"{scratch}/scratch/{label}")
    refresh_partitions(spark, _after(spark), scratch, spark.createDataFrame(CHANGED, "order_id long"))
    assert made == ["changed-orders"]
    lines = sinks.read_current(spark, scratch, "sales_order_line_items", WIDE["sales_order_line_items"])
    assert _same(lines, sales_order_line_items(_after(spark)))
