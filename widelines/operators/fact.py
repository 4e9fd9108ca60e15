"""``sales_order_fact``: one row per order with customer columns and line metrics.

The defining query left-joins both child tables to the order at once and
groups on 17 columns.  An order with ``p`` part rows and ``s`` service rows
therefore contributes ``p * s`` joined rows: the distinct counts survive
that fan-out, the quantity sums do not.

Here the children are aggregated *before* the join, per ``order_id``
(map-side partial aggregation, then one shuffle of a few numbers per
order), and the result is joined 1:1 to the order.  The inflated sums are
rebuilt exactly from the per-side row counts:

    total_parts_quantity    = coalesce(P * greatest(s, 1), 0)
    total_services_quantity = coalesce(S * greatest(p, 1), 0)

with ``P``/``S`` the per-side ``SUM(quantity)`` (NULL when no non-NULL
quantity) and ``p``/``s`` the per-side row counts.  Nothing of size
``p * s`` is ever built, and ``order_id`` is the key, so the 16 other
grouping columns are plain attributes and need no shuffle.

``true_quantities=True`` gives the corrected table (children summed once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.functions.joins import DEFAULT_MAX_BROADCAST_ROWS
from widelines.sources.model import Sources

FACT_COLUMNS = [
    "order_id", "invoice_number", "order_date", "order_type", "status", "payment_method",
    "customer_id", "first_name", "last_name", "email", "phone", "city", "state", "zip_code",
    "subtotal", "tax", "total_amount",
    "parts_line_count", "services_line_count", "total_parts_quantity",
    "total_services_quantity", "total_line_items",
]

ORDER_COLUMNS = ["order_id", "customer_id", "invoice_number", "order_date", "order_type",
                 "status", "payment_method", "subtotal", "tax", "total_amount"]
CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "email", "phone", "city",
                    "state", "zip_code"]


def orders_with_customers(src: Sources, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                          order_columns: list[str] | None = None) -> DataFrame:
    """Inner join order -> customer (orders without a customer row drop out).

    The customer side is broadcast only when a probe proves it small;
    otherwise both sides shuffle on ``customer_id`` and AQE splits a hot
    customer's partition.
    """
    customers = src.broadcast_if_small(src.customers.select(*CUSTOMER_COLUMNS), ("customers",),
                                       max_broadcast_rows)
    orders = src.sales_order.select(*(order_columns or ORDER_COLUMNS))
    return orders.join(customers, "customer_id", "inner")


def line_metrics(lines: DataFrame, prefix: str) -> DataFrame:
    """Per-order distinct line count, row count and quantity sum of one child table.

    The single ``countDistinct`` is planned as a first aggregation on
    (order_id, line_item_id) and a second on order_id, so an order with a
    huge number of lines is spread over many tasks before it is collapsed.
    """
    return lines.groupBy("order_id").agg(
        F.countDistinct("line_item_id").alias(f"{prefix}_line_count"),
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.sum("quantity").alias(f"{prefix}_quantity"),
    )


def sales_order_fact(src: Sources, true_quantities: bool = False,
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    parts = line_metrics(src.sales_order_parts.select("order_id", "line_item_id", "quantity"),
                         "parts")
    services = line_metrics(
        src.sales_order_services.select("order_id", "line_item_id", "quantity"), "services")
    # order-keyed joins first (co-partitioned on order_id, shuffle-free when the
    # sources are bucketed on it), the customer last
    customers = src.broadcast_if_small(src.customers.select(*CUSTOMER_COLUMNS), ("customers",),
                                       max_broadcast_rows)
    joined = (src.sales_order.select(*ORDER_COLUMNS)
              .join(parts, "order_id", "left")
              .join(services, "order_id", "left")
              .join(customers, "customer_id", "inner"))

    zero = F.lit(0).cast("bigint")
    p_rows = F.coalesce(F.col("parts_rows"), zero)
    s_rows = F.coalesce(F.col("services_rows"), zero)
    p_count = F.coalesce(F.col("parts_line_count"), zero)
    s_count = F.coalesce(F.col("services_line_count"), zero)
    if true_quantities:
        p_qty = F.coalesce(F.col("parts_quantity"), zero)
        s_qty = F.coalesce(F.col("services_quantity"), zero)
    else:
        p_qty = F.coalesce(F.col("parts_quantity") * F.greatest(s_rows, F.lit(1)), zero)
        s_qty = F.coalesce(F.col("services_quantity") * F.greatest(p_rows, F.lit(1)), zero)

    return joined.select(
        *FACT_COLUMNS[:17],
        p_count.alias("parts_line_count"),
        s_count.alias("services_line_count"),
        p_qty.alias("total_parts_quantity"),
        s_qty.alias("total_services_quantity"),
        (p_count + s_count).alias("total_line_items"),
    )
