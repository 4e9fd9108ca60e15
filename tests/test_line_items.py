"""Line items and catalog: NULL semantics, rounding, padding, ordering."""

from decimal import Decimal

import pytest

from builders import customer, make_sources, order, part, svc
from widelines.operators.catalog import service_parts_catalog, services_without_parts
from widelines.operators.line_items import sales_order_line_items
from widelines.operators.reports import service_cost_top
from widelines.schemas import SALES_ORDER_LINE_ITEMS, SERVICE_PARTS_CATALOG


def _src(spark, **kw):
    base = dict(customers=[customer(1), customer(2, last=None)],
                orders=[order(1, 1), order(2, 2)],
                parts=[part("p1", 1, 2), part("p9", 1, 1, sku="SKU-404")],
                services=[svc("s1", 1, 2, total="10.05"), svc("s2", 2, 0, total="10.00"),
                          svc("s3", 2, 2, total="-10.05")])
    base.update(kw)
    return make_sources(spark, **base)


def test_line_items_shape_and_semantics(spark):
    df = sales_order_line_items(_src(spark))
    assert [(f.name, f.dataType) for f in df.schema] == \
        [(f.name, f.dataType) for f in SALES_ORDER_LINE_ITEMS]
    rows = {r.line_item_id: r for r in df.collect()}
    assert "p9" not in rows  # unknown sku: inner join drops the line
    assert rows["p1"].line_item_type == "PART" and rows["p1"].vendor == "Acme"
    assert rows["p1"].labor_minutes is None and rows["p1"].labor_cost is None
    assert rows["s1"].unit_price == Decimal("5.03")   # 10.05 / 2, half up
    assert rows["s3"].unit_price == Decimal("-5.03")  # half away from zero
    assert rows["s2"].unit_price is None              # quantity 0: NULL, no error
    assert rows["s1"].vendor is None and rows["s1"].labor_minutes == 30
    assert rows["s1"].customer_name == "Ann Lee"
    assert rows["s2"].customer_name is None           # NULL last name propagates


def test_type_filter_prunes_union_branch(spark, tmp_path):
    """A filter on the discriminator removes the other branch from the plan."""
    src = _src(spark)
    plan = sales_order_line_items(src).where("line_item_type = 'PART'") \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD [line_item_id") == 1  # only the part lines are read


def test_catalog_costs_and_order(spark):
    src = _src(spark, service=[("SVC-2", "Oil change", "Engine", 30, Decimal("25.00")),
                               ("SVC-1", "Brake job", "Brakes", 60, Decimal("80.00")),
                               ("SVC-3", "Inspection", "General", 15, Decimal("10.00"))],
               service_parts=[("SVC-2", "SKU-2", 1), ("SVC-1", "SKU-2", 2),
                              ("SVC-1", "SKU-1", 4)])
    df = service_parts_catalog(src)
    assert [(f.name, f.dataType) for f in df.schema] == \
        [(f.name, f.dataType) for f in SERVICE_PARTS_CATALOG]
    rows = df.collect()
    assert [(r.serviceid, r.sku) for r in rows] == [("SVC-1", "SKU-1"), ("SVC-1", "SKU-2"),
                                                    ("SVC-2", "SKU-2")]
    assert rows[0].total_parts_cost == Decimal("20.00")
    assert rows[0].total_service_cost == Decimal("100.00")
    assert [r.serviceid for r in services_without_parts(src).collect()] == ["SVC-3"]


def test_top_services_nulls_first(spark):
    src = _src(spark, auto_parts=[("SKU-1", "Brake pad", "Brakes", None, "Acme"),
                                  ("SKU-2", "Oil filter", "Engine", Decimal("7.50"), "Bolt")],
               service_parts=[("SVC-1", "SKU-1", 4), ("SVC-2", "SKU-2", 1)])
    top = service_cost_top(service_parts_catalog(src, ordered=False)).collect()
    assert top[0].serviceid == "SVC-1" and top[0].total_parts_cost is None
    assert top[1].total_parts_cost == Decimal("7.50")


@pytest.mark.parametrize("total,qty,expected", [("10.05", 2, "5.03"), ("10.04", 2, "5.02"),
                                                ("0.01", 3, "0.00"), ("0.02", 3, "0.01")])
def test_half_up_rounding(spark, total, qty, expected):
    src = _src(spark, services=[svc("s", 1, qty, total=total)], parts=[])
    assert sales_order_line_items(src).first().unit_price == Decimal(expected)


def test_lines_meet_their_orders_last(spark):
    """With no side broadcast, the lines are shuffled while they are narrow: the invoice comes with the last join."""
    plan = sales_order_line_items(_src(spark), max_broadcast_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "order_id" in joins[0] and "item_code" in joins[1]
