"""``sales_order_line_items``: one row per part or service line.

Both kinds of line are first brought to one narrow shape (type
discriminator, item code, the type-specific columns padded with typed
NULLs) and unioned, so the large join to the order/customer frame happens
once, on ``order_id``, for all lines.  The item descriptions come from one
dimension: parts catalog and service catalog unioned under
(line_item_type, item_code), broadcast when its size is proven small.

The items come first: with both sides too large to broadcast, the lines then
cross the network while they are narrow, and leave the last join in order of
``order_id``, so that what an order's lines share compresses in the next shuffle.
Ids of digits and dashes cross the network packed (``functions.text``).

Inner joins keep the defining semantics: a line whose order, customer or
catalog row is missing is dropped.  A filter on ``line_item_type`` is
folded into the union by Catalyst, which then drops the other branch's scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.functions.joins import DEFAULT_MAX_BROADCAST_ROWS
from widelines.functions.money import safe_unit_price
from widelines.functions.text import customer_name, pack_columns, unpack_columns
from widelines.operators.fact import orders_with_customers
from widelines.sources.model import Sources

PART, SERVICE = "PART", "SERVICE"

LINE_ITEM_COLUMNS = [
    "line_item_type", "line_item_id", "order_id", "invoice_number", "order_date",
    "order_status", "customer_id", "customer_name", "customer_email", "city", "state",
    "item_code", "item_name", "item_description", "quantity", "unit_price", "line_total",
    "vendor", "labor_minutes", "labor_cost", "parts_cost",
]
#: A line's columns on their way through the joins: those that are often NULL stand together, which compresses better.
SHUFFLED_COLUMNS = ["line_item_id", "line_item_type", "item_code", "labor_minutes", "labor_cost", "parts_cost", "quantity", "order_id",
                    "unit_price", "line_total"]


def _null(dtype: str):
    """A typed NULL: the padding for the other kind's columns."""
    return F.lit(None).cast(dtype)


def part_line_shape(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.lit(PART).alias("line_item_type"), "line_item_id", "order_id",
        F.col("sku").alias("item_code"), "quantity",
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("line_total").cast("decimal(12,2)").alias("line_total"),
        _null("int").alias("labor_minutes"), _null("decimal(10,2)").alias("labor_cost"),
        _null("decimal(10,2)").alias("parts_cost"),
    )


def service_line_shape(services: DataFrame) -> DataFrame:
    return services.select(
        F.lit(SERVICE).alias("line_item_type"), "line_item_id", "order_id",
        F.col("serviceid").alias("item_code"), "quantity",
        safe_unit_price("line_total", "quantity").alias("unit_price"),
        F.col("line_total").cast("decimal(12,2)").alias("line_total"),
        "labor_minutes", "labor_cost", "parts_cost",
    )


def item_dimension(src: Sources, kinds: tuple[str, ...] = (PART, SERVICE)) -> DataFrame:
    """Parts and services under one key (line_item_type, item_code)."""
    parts = src.auto_parts.select(
        F.lit(PART).alias("line_item_type"), F.col("sku").alias("item_code"),
        F.col("name").alias("item_name"), F.col("description").alias("item_description"),
        F.col("vendor"))
    services = src.service.select(
        F.lit(SERVICE).alias("line_item_type"), F.col("serviceid").alias("item_code"),
        F.col("service").alias("item_name"), F.col("category").alias("item_description"),
        _null("string").alias("vendor"))
    if kinds == (PART,):
        return parts
    if kinds == (SERVICE,):
        return services
    return parts.unionByName(services)


def order_context(src: Sources, max_broadcast_rows: int) -> DataFrame:
    """Order and customer columns a line needs, one row per order."""
    oc = orders_with_customers(
        src, max_broadcast_rows,
        order_columns=["order_id", "customer_id", "invoice_number", "order_date", "status"])
    return oc.select(
        "order_id", "invoice_number", "order_date", F.col("status").alias("order_status"),
        "customer_id", customer_name().alias("customer_name"),
        F.col("email").alias("customer_email"), "city", "state")


def sales_order_line_items(src: Sources, kinds: tuple[str, ...] = (PART, SERVICE),
                           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    shapes = []
    if PART in kinds:
        shapes.append(part_line_shape(src.sales_order_parts))
    if SERVICE in kinds:
        shapes.append(service_line_shape(src.sales_order_services))
    lines = shapes[0]
    for other in shapes[1:]:
        lines = lines.unionByName(other)

    dimension, context = item_dimension(src, kinds), order_context(src, max_broadcast_rows)
    items = src.broadcast_if_small(dimension, ("auto_parts", "service"), max_broadcast_rows)
    orders = context
    if src.is_small("sales_order", max_broadcast_rows):  # otherwise their join with the customers would be run to count it
        orders = src.broadcast_if_small(context, ("sales_order", "customers"), max_broadcast_rows)
    packed = ("line_item_id",) if items is dimension or orders is context else ()  # lines that are shuffled
    joined = (pack_columns(lines.select(*SHUFFLED_COLUMNS), packed)
              .join(items, ["line_item_type", "item_code"], "inner")
              .join(orders, "order_id", "inner"))
    return unpack_columns(joined, packed).select(*LINE_ITEM_COLUMNS)


def part_lines(src: Sources, **kw) -> DataFrame:
    return sales_order_line_items(src, kinds=(PART,), **kw)


def service_lines(src: Sources, **kw) -> DataFrame:
    return sales_order_line_items(src, kinds=(SERVICE,), **kw)
