"""Part units implied by services sold: exact with repeated rows, and grouped after rows are dealt by part."""

import contextlib
import io
from decimal import Decimal

from builders import customer, make_sources, order, svc
from widelines.operators.catalog import service_parts_catalog
from widelines.operators.line_items import sales_order_line_items
from widelines.operators.reports import parts_demand


def _demand(spark):
    src = make_sources(
        spark, customers=[customer(1)], orders=[order(1, 1), order(2, 1)],
        services=[svc("a", 1, 2), svc("b", 2, 3), svc("c", 2, 5, serviceid="SVC-2"), svc("d", 2, None, serviceid="SVC-2")],
        auto_parts=[("SKU-1", "Pad", "Brakes", Decimal("5.00"), "Acme"), ("SKU-1", "Pad", "Brakes", Decimal("6.00"), "Acme"),
                    ("SKU-2", "Oil", "Engine", Decimal("7.50"), None), ("SKU-3", "Bulb", "Light", Decimal("1.00"), "Lux")],
        service_parts=[("SVC-1", "SKU-1", 4), ("SVC-2", "SKU-1", 1), ("SVC-1", "SKU-2", 2), ("SVC-1", "SKU-2", 10), (None, "SKU-2", 9),
                       ("SVC-3", "SKU-3", 1)])
    return parts_demand(sales_order_line_items(src), service_parts_catalog(src, ordered=False))


def test_repeated_parts_and_requirements(spark):
    got = {tuple(r) for r in _demand(spark).select("sku", "part_name", "vendor", "units_required", "service_lines",
                                                   "services_using_part").collect()}
    assert got == {("SKU-1", "Pad", "Acme", 2 * (5 * 4 + 5 * 1), 8, 2), ("SKU-2", "Oil", None, 5 * 2 + 5 * 10, 4, 1)}


def test_no_table_of_groups_beside_the_catalog(spark):
    """The rows are dealt by part first; no group is made before, and nothing is shuffled after."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        _demand(spark).explain()
    above = out.getvalue().split("REPARTITION_BY_NUM")
    assert len(above) == 2 and above[0].count("Exchange") == 1 and "hashpartitioning(sku" in above[0]
