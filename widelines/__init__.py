"""widelines: normalised order data -> wide, query-ready tables, on Spark.

Three wide tables (order fact, unified line items, service/parts catalog),
data-quality checks, versioned all-or-nothing writes, lookup layouts, CSV
export and incremental refresh, all as DataFrame plans.
"""

from widelines.sources import Sources, fixture_sources
from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items
from widelines.operators.catalog import service_parts_catalog

__all__ = [
    "Sources",
    "fixture_sources",
    "sales_order_fact",
    "sales_order_line_items",
    "service_parts_catalog",
]
