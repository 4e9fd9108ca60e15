"""``service_parts_catalog``: one row per (service, required part), with costs.

``quantity * price`` is int x decimal(10,2) -> decimal(21,2); adding the
labor cost (decimal(19,2)) gives decimal(22,2).  The table is stored in
(serviceid, sku) order: a range shuffle on the composite key, so even a
service that requires a third of all parts is split across tasks by sku.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.functions.joins import DEFAULT_MAX_BROADCAST_ROWS
from widelines.sources.model import Sources

CATALOG_COLUMNS = [
    "serviceid", "service", "category", "labor_minutes", "labor_cost", "sku", "part_name",
    "part_description", "parts_quantity_required", "part_unit_price", "total_parts_cost",
    "total_service_cost", "vendor",
]


def service_parts_catalog(src: Sources, ordered: bool = True,
                          max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    service = src.broadcast_if_small(
        src.service.select("serviceid", "service", "category", "labor_minutes", "labor_cost"),
        ("service",), max_broadcast_rows)
    parts = src.broadcast_if_small(
        src.auto_parts.select("sku", F.col("name").alias("part_name"),
                              F.col("description").alias("part_description"),
                              F.col("price").alias("part_unit_price"), "vendor"),
        ("auto_parts",), max_broadcast_rows)
    parts_cost = F.col("parts_quantity_required") * F.col("part_unit_price")
    out = (src.service_parts
           .select("serviceid", "sku", F.col("quantity").alias("parts_quantity_required"))
           .join(service, "serviceid", "inner")
           .join(parts, "sku", "inner")
           .select(
               "serviceid", "service", "category", "labor_minutes", "labor_cost", "sku",
               "part_name", "part_description", "parts_quantity_required", "part_unit_price",
               parts_cost.alias("total_parts_cost"),
               (F.col("labor_cost") + parts_cost).alias("total_service_cost"),
               "vendor"))
    if ordered:
        out = out.orderBy(F.col("serviceid").asc_nulls_last(), F.col("sku").asc_nulls_last())
    return out


def services_without_parts(src: Sources) -> DataFrame:
    """Services the inner join drops: no required-part row at all."""
    return src.service.join(src.service_parts.select("serviceid"), "serviceid", "left_anti")
