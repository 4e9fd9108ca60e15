"""A hot key holding a third of all rows: exact results, split by AQE."""

from builders import customer, make_sources, order, part, svc
from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items

HOT = 1


def _skewed(spark):
    orders = [order(o, 1 + o % 20) for o in range(1, 301)]
    parts = [part(f"h{i}", HOT, 1 + i % 5) for i in range(600)]       # a third of all lines
    parts += [part(f"p{o}-{i}", o, 2) for o in range(2, 301) for i in range(3)]
    services = [svc(f"s{o}", o, 1) for o in range(1, 301)]
    return make_sources(spark, customers=[customer(c) for c in range(1, 21)], orders=orders,
                        parts=parts, services=services)


def test_hot_order_exact(spark):
    src = _skewed(spark)
    fact = {r.order_id: r for r in sales_order_fact(src, max_broadcast_rows=0).collect()}
    hot = fact[HOT]
    assert hot.parts_line_count == 600 and hot.services_line_count == 1
    assert hot.total_parts_quantity == sum(1 + i % 5 for i in range(600))  # s = 1: no inflation
    assert fact[2].total_parts_quantity == 6 and fact[2].total_services_quantity == 3
    assert len(fact) == 300


def test_hot_order_join_is_split(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        lines = sales_order_line_items(_skewed(spark), max_broadcast_rows=0)
        assert len(lines.collect()) == 600 + 299 * 3 + 300
        plan = lines._jdf.queryExecution().executedPlan().toString()  # final AQE plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_month_folder_is_written_by_several_tasks(spark, scratch):
    """REBALANCE lets AQE split a layout folder holding a third of all rows."""
    import datetime as dt
    import os

    from widelines.plans.layouts import write_layout

    hot = dt.datetime(2025, 3, 15)
    orders = [order(o, 1 + o % 20, when=hot if o % 3 == 0 else dt.datetime(2024, 1 + o % 12, 1))
              for o in range(1, 3001)]
    src = make_sources(spark, customers=[customer(c) for c in range(1, 21)], orders=orders)
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        w = write_layout(sales_order_fact(src), scratch, "sales_order_fact")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    folder = os.path.join(w.path.removeprefix("file:"), "order_year=2025", "order_month=3")
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert w.row_count == 3000 and len(files) > 1
