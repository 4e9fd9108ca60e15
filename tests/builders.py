"""Hand-made source bundles for the edge-case tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.schemas import SALES_ORDER_FACT, SOURCES
from widelines.sources.model import Sources

T0 = dt.datetime(2025, 1, 15, 10, 30, 0)


def customer(cid, first="Ann", last="Lee", phone="555-0100", city="Austin", state="TX"):
    return (cid, first, last, f"c{cid}@x.com", phone, city, state, "78701")


def order(oid, cid, total="108.00", status="Completed", when=T0):
    sub = (Decimal(total) / Decimal("1.08")).quantize(Decimal("0.01"))
    tax = Decimal(total) - sub
    return (oid, cid, when, f"INV-{oid:05d}", "Card", sub, tax, Decimal(total), "Mixed", status,
            when, when)


def part(lid, oid, qty, total="10.00", sku="SKU-1", unit="5.00"):
    return (lid, oid, sku, qty, None if unit is None else Decimal(unit), Decimal(total))


def svc(lid, oid, qty, total="20.00", serviceid="SVC-1"):
    t = Decimal(total)
    labor = (t * Decimal("0.60")).quantize(Decimal("0.01"))
    return (lid, oid, serviceid, qty, t, None if qty is None else qty * 15, labor, t - labor)


def make_sources(spark, customers=(), orders=(), parts=(), services=(), auto_parts=None,
                 service=None, service_parts=None) -> Sources:
    auto_parts = auto_parts if auto_parts is not None else [
        ("SKU-1", "Brake pad", "Brakes", Decimal("5.00"), "Acme"),
        ("SKU-2", "Oil filter", "Engine", Decimal("7.50"), "Bolt")]
    service = service if service is not None else [
        ("SVC-1", "Brake job", "Brakes", 60, Decimal("80.00")),
        ("SVC-2", "Oil change", "Engine", 30, Decimal("25.00"))]
    service_parts = service_parts if service_parts is not None else [
        ("SVC-1", "SKU-1", 4), ("SVC-2", "SKU-2", 1)]
    data = {
        "customers": customers, "sales_order": orders, "sales_order_parts": parts,
        "sales_order_services": services, "auto_parts": auto_parts, "service": service,
        "service_parts": service_parts,
    }
    return Sources(**{name: spark.createDataFrame(list(rows), SOURCES[name])
                      for name, rows in data.items()})


def fanned_out_fact(src: Sources) -> DataFrame:
    """The order fact by brute force: both kinds of lines joined to the order, grouped by every field that is no metric."""
    kinds = {"parts": src.sales_order_parts, "services": src.sales_order_services}
    wide = src.sales_order.join(src.customers, "customer_id")
    for kind, lines in kinds.items():
        wide = wide.join(lines.select("order_id", F.col("line_item_id").alias(f"{kind}_id"),
                                      F.col("quantity").alias(f"{kind}_quantity")), "order_id", "left")
    counts = {kind: F.countDistinct(f"{kind}_id") for kind in kinds}
    metrics = {f"{kind}_line_count": n for kind, n in counts.items()}
    metrics |= {f"total_{kind}_quantity": F.coalesce(F.sum(f"{kind}_quantity"), F.lit(0)) for kind in kinds}
    metrics["total_line_items"] = counts["parts"] + counts["services"]
    fields = SALES_ORDER_FACT.fieldNames()
    return wide.groupBy(*(f for f in fields if f not in metrics)).agg(
        *(m.alias(name) for name, m in metrics.items())).select(*fields)
