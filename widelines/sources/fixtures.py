"""The seven source tables derived from the TPC-H-like test tables.

Mapping (fixed by the fixture definition): orders play sales orders,
customers joined to nation and region play customers, line items with
return flag ``R`` play service lines and the rest play part lines, parts
play the parts catalog and suppliers play the service catalog.  The
service/part requirement table is the total quantity per (service, part)
pair seen on any line.

Every frame is lazy; Catalyst prunes the columns a builder does not use
down to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widelines.functions.joins import broadcast_if_small_files
from widelines.functions.money import safe_unit_price
from widelines.functions.text import pad_code
from widelines.sources.model import Sources
from widelines.sources.tables import read_raw

# Fixed values of the fixture definition.
SERVICE_FLAG = "R"
TAX_RATE = "0.08"
LABOR_SHARE = "0.60"
LABOR_MINUTES_PER_UNIT = 15
ORDER_TYPE_BY_STATUS = {"F": "Parts", "O": "Service"}  # otherwise "Mixed"
ORDER_STATUS_BY_STATUS = {"F": "Completed", "O": "Open"}  # otherwise "Pending"


def _dec(value: str, precision: int = 3, scale: int = 2):
    return F.lit(value).cast(f"decimal({precision},{scale})")


def _case(col: str, mapping: dict[str, str], default: str):
    expr = None
    for key, value in mapping.items():
        expr = (F.when(F.col(col) == key, value) if expr is None
                else expr.when(F.col(col) == key, value))
    return expr.otherwise(default)


def customers_from(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(broadcast_if_small_files(region), nation.n_regionkey == region.r_regionkey)
    key = F.col("c_custkey")
    return (
        customer.join(broadcast_if_small_files(geo.select("n_nationkey", "n_name", "r_name"), nation, region),
                      customer.c_nationkey == F.col("n_nationkey"))
        .select(
            key.alias("customer_id"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.when(key % 10 == 0, F.lit(None).cast("string"))
            .otherwise(pad_code("555-", key, 7)).alias("phone"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("zip_code"),
        )
    )


def sales_order_from(orders: DataFrame) -> DataFrame:
    subtotal = F.col("o_totalprice").cast("decimal(12,2)")
    tax = F.round(subtotal * _dec(TAX_RATE), 2).cast("decimal(12,2)")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        pad_code("INV-", "o_orderkey", 10).alias("invoice_number"),
        F.col("o_orderpriority").alias("payment_method"),
        subtotal.alias("subtotal"),
        tax.alias("tax"),
        (subtotal + tax).cast("decimal(12,2)").alias("total_amount"),
        _case("o_orderstatus", ORDER_TYPE_BY_STATUS, "Mixed").alias("order_type"),
        _case("o_orderstatus", ORDER_STATUS_BY_STATUS, "Pending").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def lines_from(lineitem: DataFrame) -> DataFrame:
    """Common line projection; ``line_item_id`` is unique on the test data."""
    line_total = F.col("l_extendedprice").cast("decimal(12,2)")
    cents = (line_total * 100).cast("bigint")
    return lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string"), F.lit("-"),
                 F.col("l_partkey").cast("string"), F.lit("-"),
                 cents.cast("string")).alias("line_item_id"),
        F.col("l_orderkey").alias("order_id"),
        pad_code("SKU-", "l_partkey", 8).alias("sku"),
        pad_code("SVC-", "l_suppkey", 6).alias("serviceid"),
        F.col("l_quantity").cast("int").alias("quantity"),
        line_total.alias("line_total"),
        F.col("l_returnflag").alias("flag"),
    )


def parts_from(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("flag") != SERVICE_FLAG).select(
        "line_item_id", "order_id", "sku", "quantity",
        safe_unit_price("line_total", "quantity").alias("unit_price"),
        "line_total",
    )


def services_from(lines: DataFrame) -> DataFrame:
    labor = F.round(F.col("line_total") * _dec(LABOR_SHARE), 2)
    return lines.where(F.col("flag") == SERVICE_FLAG).select(
        "line_item_id", "order_id", "serviceid", "quantity", "line_total",
        (F.col("quantity") * LABOR_MINUTES_PER_UNIT).alias("labor_minutes"),
        labor.cast("decimal(10,2)").alias("labor_cost"),
        (F.col("line_total") - labor).cast("decimal(10,2)").alias("parts_cost"),
    )


def auto_parts_from(part: DataFrame) -> DataFrame:
    return part.select(
        pad_code("SKU-", "p_partkey", 8).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("description"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("p_brand").alias("vendor"),
    )


def service_from(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(
        broadcast_if_small_files(nation.select("n_nationkey", "n_name"), nation),
        supplier.s_nationkey == F.col("n_nationkey"),
    ).select(
        pad_code("SVC-", "s_suppkey", 6).alias("serviceid"),
        F.col("s_name").alias("service"),
        F.col("n_name").alias("category"),
        (F.lit(30) + (F.col("s_suppkey") % 8) * 15).cast("int").alias("labor_minutes"),
        F.col("s_acctbal").cast("decimal(19,2)").alias("labor_cost"),
    )


def service_parts_from(lineitem: DataFrame) -> DataFrame:
    """Required quantity per (service, part).

    Grouped on the integer keys (cheap hashing, map-side partial
    aggregation) and formatted afterwards; the code formats are one-to-one.
    """
    return (lineitem.groupBy("l_suppkey", "l_partkey")
            .agg(F.sum(F.col("l_quantity").cast("int")).cast("int").alias("quantity"))
            .select(pad_code("SVC-", "l_suppkey", 6).alias("serviceid"),
                    pad_code("SKU-", "l_partkey", 8).alias("sku"),
                    "quantity"))


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The seven sources over ``sf_dir``; nothing is read until an action."""
    raw = {name: read_raw(spark, sf_dir, name)
           for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    lines = lines_from(raw["lineitem"])
    return Sources(
        customers=customers_from(raw["customer"], raw["nation"], raw["region"]),
        sales_order=sales_order_from(raw["orders"]),
        sales_order_parts=parts_from(lines),
        sales_order_services=services_from(lines),
        auto_parts=auto_parts_from(raw["part"]),
        service=service_from(raw["supplier"], raw["nation"]),
        service_parts=service_parts_from(raw["lineitem"]),
    )
