"""Pinned schemas: the raw test tables, the seven sources and the three wide tables.

Reading Parquet with an explicit schema skips footer-based inference and
makes every type a decision rather than an accident.  Money is always a
``DecimalType``; never a double.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS = T.TimestampNTZType()


def dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


MONEY_12 = dec(12, 2)
MONEY_10 = dec(10, 2)
MONEY_19 = dec(19, 2)  # PostgreSQL MONEY: 64-bit cents

# ---------------------------------------------------------------- raw tables
RAW = {
    "region": _struct(("r_regionkey", I), ("r_name", S)),
    "nation": _struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _struct(
        ("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)
    ),
    "supplier": _struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _struct(
        ("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
        ("p_retailprice", D),
    ),
    "orders": _struct(
        ("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
        ("o_orderdate", TS), ("o_orderpriority", S),
    ),
    "lineitem": _struct(
        ("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS),
    ),
}

# -------------------------------------------------------------- seven sources
CUSTOMERS = _struct(
    ("customer_id", L), ("first_name", S), ("last_name", S), ("email", S), ("phone", S),
    ("city", S), ("state", S), ("zip_code", S),
)
SALES_ORDER = _struct(
    ("order_id", L), ("customer_id", L), ("order_date", TS), ("invoice_number", S),
    ("payment_method", S), ("subtotal", MONEY_12), ("tax", MONEY_12), ("total_amount", MONEY_12),
    ("order_type", S), ("status", S), ("created_at", TS), ("updated_at", TS),
)
SALES_ORDER_PARTS = _struct(
    ("line_item_id", S), ("order_id", L), ("sku", S), ("quantity", I),
    ("unit_price", MONEY_10), ("line_total", MONEY_12),
)
SALES_ORDER_SERVICES = _struct(
    ("line_item_id", S), ("order_id", L), ("serviceid", S), ("quantity", I),
    ("line_total", MONEY_12), ("labor_minutes", I), ("labor_cost", MONEY_10),
    ("parts_cost", MONEY_10),
)
AUTO_PARTS = _struct(
    ("sku", S), ("name", S), ("description", S), ("price", MONEY_10), ("vendor", S)
)
SERVICE = _struct(
    ("serviceid", S), ("service", S), ("category", S), ("labor_minutes", I),
    ("labor_cost", MONEY_19),
)
SERVICE_PARTS = _struct(("serviceid", S), ("sku", S), ("quantity", I))

SOURCES = {
    "customers": CUSTOMERS,
    "sales_order": SALES_ORDER,
    "sales_order_parts": SALES_ORDER_PARTS,
    "sales_order_services": SALES_ORDER_SERVICES,
    "auto_parts": AUTO_PARTS,
    "service": SERVICE,
    "service_parts": SERVICE_PARTS,
}

# ---------------------------------------------------------------- wide tables
SALES_ORDER_FACT = _struct(
    ("order_id", L), ("invoice_number", S), ("order_date", TS), ("order_type", S),
    ("status", S), ("payment_method", S), ("customer_id", L), ("first_name", S),
    ("last_name", S), ("email", S), ("phone", S), ("city", S), ("state", S), ("zip_code", S),
    ("subtotal", MONEY_12), ("tax", MONEY_12), ("total_amount", MONEY_12),
    ("parts_line_count", L), ("services_line_count", L), ("total_parts_quantity", L),
    ("total_services_quantity", L), ("total_line_items", L),
)
SALES_ORDER_LINE_ITEMS = _struct(
    ("line_item_type", S), ("line_item_id", S), ("order_id", L), ("invoice_number", S),
    ("order_date", TS), ("order_status", S), ("customer_id", L), ("customer_name", S),
    ("customer_email", S), ("city", S), ("state", S), ("item_code", S), ("item_name", S),
    ("item_description", S), ("quantity", I), ("unit_price", MONEY_10), ("line_total", MONEY_12),
    ("vendor", S), ("labor_minutes", I), ("labor_cost", MONEY_10), ("parts_cost", MONEY_10),
)
SERVICE_PARTS_CATALOG = _struct(
    ("serviceid", S), ("service", S), ("category", S), ("labor_minutes", I),
    ("labor_cost", MONEY_19), ("sku", S), ("part_name", S), ("part_description", S),
    ("parts_quantity_required", I), ("part_unit_price", MONEY_10),
    ("total_parts_cost", dec(21, 2)), ("total_service_cost", dec(22, 2)), ("vendor", S),
)

WIDE = {
    "sales_order_fact": SALES_ORDER_FACT,
    "sales_order_line_items": SALES_ORDER_LINE_ITEMS,
    "service_parts_catalog": SERVICE_PARTS_CATALOG,
}
