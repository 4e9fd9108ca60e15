"""Registered queries (name -> callable(spark, sf_dir)) and their DuckDB oracles.

Every query reads the test tables of ``sf_dir`` in full through
``fixture_sources``; the oracle for the same name (see ``widelines.oracle``)
derives the same sources and wide tables in DuckDB.  Queries that write
(round trips, layouts, the pipeline) write below the session's shared
checkpoint folder and return what they read back.
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widelines.oracle import with_ctes
from widelines.operators import access, checks, reports
from widelines.operators.catalog import service_parts_catalog, services_without_parts
from widelines.operators.fact import (ORDER_COLUMNS, CUSTOMER_COLUMNS, line_metrics,
                                      orders_with_customers, sales_order_fact)
from widelines.operators.line_items import (part_lines, sales_order_line_items,
                                            service_lines)
from widelines.functions.money import safe_unit_price
from widelines.functions.text import customer_name
from widelines.plans import clustering, layouts, publish_log, sinks
from widelines.plans.file_index import build_file_index, lookup, lookup_values
from widelines.plans.pipeline import run_pipeline, summary_frame
from widelines.schemas import WIDE
from widelines.session import scratch_path
from widelines.sources.fixtures import fixture_sources
from widelines.streaming import rollups
from widelines.streaming.incremental import (ORDER_TABLES, ROLLUPS, changed_since, refresh_fact, refresh_partitions,
                                             restrict, snapshot_before, write_rollups)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered lookups and reports (values of the test data).
RUN_DATE = _dt.date(2025, 12, 10)
RUN_TS = "2025-12-10 00:00:00"
REFRESH_CUTOFF = _dt.datetime(1999, 1, 1)
FACT_RANGE = (_dt.date(1997, 1, 1), _dt.date(1998, 1, 1))
LINES_RANGE = (_dt.date(1999, 1, 1), _dt.date(2000, 1, 1))
STATUS_LIST = ["Open", "Pending"]
LOOKUP_STATUS = "Pending"
LOOKUP_STATE, LOOKUP_CITY = "EUROPE", "NATION_8"
LOOKUP_LINE_STATE = "ASIA"
LOOKUP_CATEGORY = "NATION_3"
LOOKUP_VENDOR = "Brand#4"
MAX_QUANTITY = 50
BIG_ORDER_LINES = 8
EXPENSIVE_PART_PRICE = "990.00"


def register(name: str, oracle_body: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_body is not None:
            ORACLE[name] = with_ctes(oracle_body)
        return fn
    return deco


def _src(spark, sf_dir):
    return fixture_sources(spark, sf_dir)


def _fact(spark, sf_dir):
    return sales_order_fact(_src(spark, sf_dir))


def _lines(spark, sf_dir):
    return sales_order_line_items(_src(spark, sf_dir))


def _catalog(spark, sf_dir, ordered=True):
    return service_parts_catalog(_src(spark, sf_dir), ordered=ordered)


# A table's layout, index and curve are written once per application and state of the folder, when the first lookup
# reads them, and shared by all later ones.
_LAYOUT_ROOTS: dict[tuple, str] = {}
_STORED: set[tuple] = set()
_REFRESH_ROOTS: dict[tuple, str] = {}
_LAYOUT_LOCK = threading.RLock()


def _folder_state(spark, sf_dir) -> tuple:
    store = publish_log.Store(spark, sf_dir)
    return (spark.sparkContext.applicationId, sf_dir, tuple(sorted((n, t) for n, _, t in store.names(""))))


def _once(spark, sf_dir, step, table, write) -> str:
    """The folder of the laid-out tables, after ``write(root)`` has stored ``step`` of ``table`` there."""
    key = _folder_state(spark, sf_dir)
    with _LAYOUT_LOCK:
        root = _LAYOUT_ROOTS.setdefault(key, scratch_path(spark, "layouts"))
        if (root, step, table) not in _STORED:
            write(root)
            _STORED.add((root, step, table))
        return root


def _layout_root(spark, sf_dir, table) -> str:
    builds = {"sales_order_fact": _fact, "sales_order_line_items": _lines,
              "service_parts_catalog": lambda *at: _catalog(*at, ordered=False)}
    return _once(spark, sf_dir, "layout", table,
                 lambda root: layouts.write_layout(builds[table](spark, sf_dir), root, table))


def _index_root(spark, sf_dir, table) -> str:
    """The layout of ``table`` with its lookup index."""
    def index(root):
        build_file_index(spark, root, table, sinks.current_version(spark, root, table),
                         layouts.INDEX_RANGES[table], layouts.INDEX_SKETCHES[table])

    _layout_root(spark, sf_dir, table)
    return _once(spark, sf_dir, "index", table, index)


def _curve_root(spark, sf_dir, table) -> str:
    """The layout of an order-grained ``table``, and the table along its curve with the index of that."""
    def cluster(root):
        clustering.write_clustered(_wide_cols(layouts.read_layout(spark, root, table), table), root, table)

    _layout_root(spark, sf_dir, table)
    return _once(spark, sf_dir, "curve", table, cluster)


def _looked_up(spark, sf_dir, table, column, probe, clustered=False) -> DataFrame:
    stored = clustering.clustered_name(table) if clustered else table
    root = (_curve_root if clustered else _index_root)(spark, sf_dir, table)
    return _wide_cols(lookup(spark, root, stored, column, probe), table)


def _laid_out(spark, sf_dir, table) -> DataFrame:
    return layouts.read_layout(spark, _layout_root(spark, sf_dir, table), table)


def _wide_cols(df: DataFrame, table: str) -> DataFrame:
    return df.select(*WIDE[table].fieldNames())


# --------------------------------------------------------------- 2.1 sources, sinks
@register("source_row_counts", """
SELECT 'customers' AS table_name, count(*) AS row_count FROM src_customers
UNION ALL SELECT 'sales_order', count(*) FROM src_sales_order
UNION ALL SELECT 'sales_order_parts', count(*) FROM src_sales_order_parts
UNION ALL SELECT 'sales_order_services', count(*) FROM src_sales_order_services
UNION ALL SELECT 'auto_parts', count(*) FROM src_auto_parts
UNION ALL SELECT 'service', count(*) FROM src_service
UNION ALL SELECT 'service_parts', count(*) FROM src_service_parts""")
def q_source_row_counts(spark, sf_dir):
    return checks.wide_row_counts(_src(spark, sf_dir).as_dict())


@register("materialized_fact_roundtrip", "SELECT * FROM w_fact")
def q_materialized_fact_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "materialized")
    sinks.write_version(_fact(spark, sf_dir), root, "sales_order_fact")
    return sinks.read_current(spark, root, "sales_order_fact", WIDE["sales_order_fact"])


@register("rebuild_is_idempotent", "SELECT * FROM w_fact")
def q_rebuild_is_idempotent(spark, sf_dir):
    root = scratch_path(spark, "rebuild")
    first = sinks.write_version(_fact(spark, sf_dir), root, "sales_order_fact")
    second = sinks.write_version(_fact(spark, sf_dir), root, "sales_order_fact")
    assert first.row_count == second.row_count and first.version != second.version
    return sinks.read_current(spark, root, "sales_order_fact", WIDE["sales_order_fact"])


def _csv_roundtrip(spark, df, table):
    ok, path = sinks.export_csv(df, scratch_path(spark, "csv"), table, RUN_DATE)
    if not ok:
        raise RuntimeError(f"CSV export of {table} failed")
    return sinks.read_csv(spark, path, WIDE[table])


@register("csv_roundtrip_fact", "SELECT * FROM w_fact")
def q_csv_roundtrip_fact(spark, sf_dir):
    return _csv_roundtrip(spark, _fact(spark, sf_dir), "sales_order_fact")


@register("csv_roundtrip_line_items", "SELECT * FROM w_lines")
def q_csv_roundtrip_line_items(spark, sf_dir):
    """Exported from a stored version, as the pipeline does: the files of the joins' shuffles are gone by then."""
    table, root = "sales_order_line_items", scratch_path(spark, "csv-lines")
    sinks.write_version(_lines(spark, sf_dir), root, table, writer_options={"compression": "zstd"})
    return _csv_roundtrip(spark, sinks.read_current(spark, root, table, WIDE[table]), table)


@register("csv_roundtrip_catalog", "SELECT * FROM w_catalog")
def q_csv_roundtrip_catalog(spark, sf_dir):
    return _csv_roundtrip(spark, _catalog(spark, sf_dir), "service_parts_catalog")


@register("preview_fact", "SELECT * FROM w_fact ORDER BY order_id LIMIT 5")
def q_preview_fact(spark, sf_dir):
    return reports.preview(_fact(spark, sf_dir), "order_id")


@register("preview_line_items", """
SELECT * FROM w_lines ORDER BY order_id, line_item_type, line_item_id LIMIT 5""")
def q_preview_line_items(spark, sf_dir):
    return reports.preview(_lines(spark, sf_dir), "order_id", "line_item_type", "line_item_id")


@register("preview_catalog", "SELECT * FROM w_catalog ORDER BY serviceid, sku LIMIT 5")
def q_preview_catalog(spark, sf_dir):
    return reports.preview(_catalog(spark, sf_dir, ordered=False), "serviceid", "sku")


# ------------------------------------------------------- 2.2 projections, 2.9 tables
@register("sales_order_fact", "SELECT * FROM w_fact")
def q_sales_order_fact(spark, sf_dir):
    return _fact(spark, sf_dir)


@register("part_lines", "SELECT * FROM w_part_lines")
def q_part_lines(spark, sf_dir):
    return part_lines(_src(spark, sf_dir))


@register("service_lines", "SELECT * FROM w_service_lines")
def q_service_lines(spark, sf_dir):
    return service_lines(_src(spark, sf_dir))


@register("sales_order_line_items", "SELECT * FROM w_lines")
def q_sales_order_line_items(spark, sf_dir):
    return _lines(spark, sf_dir)


@register("service_parts_catalog", "SELECT * FROM w_catalog")
def q_service_parts_catalog(spark, sf_dir):
    return _catalog(spark, sf_dir)


@register("line_items_by_type", """
SELECT line_item_type, count(*) AS row_count,
       CAST(sum(line_total) AS DECIMAL(22,2)) AS total_revenue
FROM w_lines GROUP BY line_item_type ORDER BY line_item_type""")
def q_line_items_by_type(spark, sf_dir):
    return reports.line_items_by_type(_lines(spark, sf_dir))


@register("line_item_null_padding", """
SELECT line_item_type, count(*) AS row_count, count(vendor) AS vendor_values,
       count(labor_minutes) AS labor_minutes_values, count(labor_cost) AS labor_cost_values,
       count(parts_cost) AS parts_cost_values
FROM w_lines GROUP BY line_item_type""")
def q_line_item_null_padding(spark, sf_dir):
    return reports.null_padding_profile(_lines(spark, sf_dir))


# ---------------------------------------------------------------- 2.3 filters
@register("status_in_list", f"""
SELECT order_id, status, total_amount FROM w_fact
WHERE status IN ({", ".join(f"'{s}'" for s in STATUS_LIST)})""")
def q_status_in_list(spark, sf_dir):
    return (_fact(spark, sf_dir).where(F.col("status").isin(STATUS_LIST))
            .select("order_id", "status", "total_amount"))


# ---------------------------------------------------------------- 2.4 joins
@register("orders_with_customer", f"""
SELECT {", ".join("o." + c for c in ORDER_COLUMNS)},
       {", ".join("c." + c for c in CUSTOMER_COLUMNS if c != "customer_id")}
FROM src_sales_order o JOIN src_customers c ON c.customer_id = o.customer_id""")
def q_orders_with_customer(spark, sf_dir):
    return orders_with_customers(_src(spark, sf_dir))


def _child_metrics_sql(table: str, prefix: str) -> str:
    return f"""
SELECT o.order_id,
       count(DISTINCT x.line_item_id) AS {prefix}_line_count,
       count(x.order_id) AS {prefix}_rows,
       CAST(coalesce(sum(x.quantity), 0) AS BIGINT) AS {prefix}_quantity
FROM src_sales_order o LEFT JOIN {table} x ON x.order_id = o.order_id
GROUP BY o.order_id"""


def _child_metrics(src, lines, prefix):
    m = line_metrics(lines.select("order_id", "line_item_id", "quantity"), prefix)
    zero = F.lit(0).cast("bigint")
    return (src.sales_order.select("order_id").join(m, "order_id", "left")
            .select("order_id",
                    *[F.coalesce(f"{prefix}_{c}", zero).alias(f"{prefix}_{c}")
                      for c in ("line_count", "rows", "quantity")]))


@register("order_parts_metrics", _child_metrics_sql("src_sales_order_parts", "parts"))
def q_order_parts_metrics(spark, sf_dir):
    src = _src(spark, sf_dir)
    return _child_metrics(src, src.sales_order_parts, "parts")


@register("order_services_metrics", _child_metrics_sql("src_sales_order_services", "services"))
def q_order_services_metrics(spark, sf_dir):
    src = _src(spark, sf_dir)
    return _child_metrics(src, src.sales_order_services, "services")


# ------------------------------------------------------- 2.5 aggregations, 2.7 top-k
@register("service_cost_top10", """
SELECT serviceid, service, count(*) AS parts_required,
       CAST(sum(parts_quantity_required) AS BIGINT) AS total_parts_quantity,
       CAST(sum(total_parts_cost) AS DECIMAL(31,2)) AS total_parts_cost,
       CAST(avg(labor_cost) AS DECIMAL(23,6)) AS labor_cost
FROM w_catalog GROUP BY serviceid, service
ORDER BY total_parts_cost DESC NULLS FIRST, serviceid LIMIT 10""")
def q_service_cost_top10(spark, sf_dir):
    return reports.service_cost_top(_catalog(spark, sf_dir, ordered=False))


@register("wide_row_counts", """
SELECT 'sales_order_fact' AS table_name, count(*) AS row_count FROM w_fact
UNION ALL SELECT 'sales_order_line_items', count(*) FROM w_lines
UNION ALL SELECT 'service_parts_catalog', count(*) FROM w_catalog""")
def q_wide_row_counts(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.wide_row_counts({
        "sales_order_fact": sales_order_fact(src),
        "sales_order_line_items": sales_order_line_items(src),
        "service_parts_catalog": service_parts_catalog(src, ordered=False)})


@register("financial_totals", """
SELECT 'Source' AS source, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue
FROM src_sales_order
UNION ALL
SELECT 'Denormalized', CAST(sum(total_amount) AS DECIMAL(22,2)) FROM w_fact""")
def q_financial_totals(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.financial_totals_pair(src, sales_order_fact(src))


@register("source_line_counts", """
SELECT o.order_id, count(DISTINCT p.line_item_id) AS parts_count,
       count(DISTINCT s.line_item_id) AS services_count
FROM src_sales_order o
LEFT JOIN src_sales_order_parts p ON p.order_id = o.order_id
LEFT JOIN src_sales_order_services s ON s.order_id = o.order_id
GROUP BY o.order_id""")
def q_source_line_counts(spark, sf_dir):
    return checks.source_line_counts(_src(spark, sf_dir))


# ------------------------------------------------------------ 2.8 expressions
@register("customer_name", """
SELECT customer_id, first_name || ' ' || last_name AS customer_name FROM src_customers""")
def q_customer_name(spark, sf_dir):
    return _src(spark, sf_dir).customers.select("customer_id",
                                                customer_name().alias("customer_name"))


@register("service_unit_price", """
SELECT line_item_id, quantity, line_total,
       CAST((cents * 2 + quantity) // (2 * NULLIF(quantity, 0)) * CAST(0.01 AS DECIMAL(3,2))
            AS DECIMAL(10,2)) AS unit_price
FROM src_sales_order_services""")
def q_service_unit_price(spark, sf_dir):
    return _src(spark, sf_dir).sales_order_services.select(
        "line_item_id", "quantity", "line_total",
        safe_unit_price("line_total", "quantity").alias("unit_price"))


@register("financial_check", """
WITH t AS (
    SELECT (SELECT CAST(sum(total_amount) AS DECIMAL(22,2)) FROM src_sales_order) AS source_total,
           (SELECT CAST(sum(total_amount) AS DECIMAL(22,2)) FROM w_fact) AS denormalized_total)
SELECT source_total, denormalized_total,
       coalesce(abs(source_total - denormalized_total) < 0.01, false) AS passed
FROM t""")
def q_financial_check(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.financial_check(src, sales_order_fact(src))


# ------------------------------------------------------------------ 2.9 checks
@register("val_row_counts", """
SELECT 'Source: sales_order' AS table_name, count(*) AS row_count FROM src_sales_order
UNION ALL SELECT 'Source: sales_order_parts', count(*) FROM src_sales_order_parts
UNION ALL SELECT 'Source: sales_order_services', count(*) FROM src_sales_order_services
UNION ALL SELECT 'Source: customers', count(*) FROM src_customers
UNION ALL SELECT 'Denormalized: sales_order_fact', count(*) FROM w_fact
UNION ALL SELECT 'Denormalized: sales_order_line_items', count(*) FROM w_lines
UNION ALL SELECT 'Denormalized: service_parts_catalog', count(*) FROM w_catalog""")
def q_val_row_counts(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.row_counts(src, sales_order_fact(src), sales_order_line_items(src),
                             service_parts_catalog(src, ordered=False))


@register("val_financial_totals", """
SELECT 'Source (sales_order)' AS source,
       CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue,
       CAST(sum(subtotal) AS DECIMAL(22,2)) AS total_subtotal,
       CAST(sum(tax) AS DECIMAL(22,2)) AS total_tax
FROM src_sales_order
UNION ALL
SELECT 'Denormalized (sales_order_fact)', CAST(sum(total_amount) AS DECIMAL(22,2)),
       CAST(sum(subtotal) AS DECIMAL(22,2)), CAST(sum(tax) AS DECIMAL(22,2))
FROM w_fact""")
def q_val_financial_totals(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.financial_totals(src, sales_order_fact(src))


@register("val_line_totals", """
SELECT 'Source: Parts' AS source, CAST(sum(line_total) AS DECIMAL(22,2)) AS total_line_amount
FROM src_sales_order_parts
UNION ALL SELECT 'Source: Services', CAST(sum(line_total) AS DECIMAL(22,2))
FROM src_sales_order_services
UNION ALL SELECT 'Denormalized: Parts', CAST(sum(line_total) AS DECIMAL(22,2))
FROM w_lines WHERE line_item_type = 'PART'
UNION ALL SELECT 'Denormalized: Services', CAST(sum(line_total) AS DECIMAL(22,2))
FROM w_lines WHERE line_item_type = 'SERVICE'""")
def q_val_line_totals(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.line_totals(src, sales_order_line_items(src))


@register("val_orphans", """
SELECT 'Orphaned orders in sales_order_fact' AS check_name, count(*) AS issue_count
FROM w_fact f WHERE NOT EXISTS (SELECT 1 FROM src_sales_order o WHERE o.order_id = f.order_id)
UNION ALL
SELECT 'Missing customers in sales_order_fact', count(*)
FROM w_fact f WHERE NOT EXISTS (SELECT 1 FROM src_customers c WHERE c.customer_id = f.customer_id)
UNION ALL
SELECT 'Orphaned line items', count(*)
FROM w_lines l WHERE NOT EXISTS (SELECT 1 FROM src_sales_order o WHERE o.order_id = l.order_id)""")
def q_val_orphans(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.orphan_checks(src, sales_order_fact(src), sales_order_line_items(src))


@register("val_missing_from_fact", """
SELECT 'Source orders missing from sales_order_fact' AS check_name, count(*) AS issue_count
FROM src_sales_order o WHERE NOT EXISTS (SELECT 1 FROM w_fact f WHERE f.order_id = o.order_id)""")
def q_val_missing_from_fact(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.missing_from_fact(src, sales_order_fact(src))


@register("val_null_checks", """
SELECT 'sales_order_fact: NULL order_id' AS check_name, count(*) FILTER (WHERE order_id IS NULL)
       AS issue_count FROM w_fact
UNION ALL SELECT 'sales_order_fact: NULL customer_id', count(*) FILTER (WHERE customer_id IS NULL)
FROM w_fact
UNION ALL SELECT 'sales_order_fact: NULL total_amount', count(*) FILTER (WHERE total_amount IS NULL)
FROM w_fact
UNION ALL SELECT 'sales_order_line_items: NULL order_id', count(*) FILTER (WHERE order_id IS NULL)
FROM w_lines
UNION ALL SELECT 'sales_order_line_items: NULL line_total',
       count(*) FILTER (WHERE line_total IS NULL) FROM w_lines""")
def q_val_null_checks(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.null_checks(sales_order_fact(src), sales_order_line_items(src))


@register("val_negative_checks", """
SELECT 'Negative quantities in line items' AS check_name,
       count(*) FILTER (WHERE quantity < 0) AS issue_count FROM w_lines
UNION ALL SELECT 'Negative prices in line items', count(*) FILTER (WHERE unit_price < 0)
FROM w_lines""")
def q_val_negative_checks(spark, sf_dir):
    return checks.negative_checks(_lines(spark, sf_dir))


@register("val_count_mismatch", """
WITH sc AS (
    SELECT o.order_id, count(DISTINCT p.line_item_id) AS parts_count,
           count(DISTINCT s.line_item_id) AS services_count
    FROM src_sales_order o
    LEFT JOIN src_sales_order_parts p ON p.order_id = o.order_id
    LEFT JOIN src_sales_order_services s ON s.order_id = o.order_id
    GROUP BY o.order_id),
j AS (SELECT * FROM sc JOIN w_fact f ON f.order_id = sc.order_id)
SELECT 'Orders with mismatched parts count' AS check_name,
       count(*) FILTER (WHERE parts_count <> parts_line_count) AS issue_count FROM j
UNION ALL
SELECT 'Orders with mismatched services count',
       count(*) FILTER (WHERE services_count <> services_line_count) FROM j""")
def q_val_count_mismatch(spark, sf_dir):
    src = _src(spark, sf_dir)
    return checks.count_mismatch(src, sales_order_fact(src))


@register("val_uniqueness", """
SELECT 'Repeated order_id in sales_order' AS check_name, count(*) AS issue_count
FROM (SELECT order_id FROM src_sales_order WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1)
UNION ALL
SELECT 'Repeated invoice_number in sales_order', count(*)
FROM (SELECT invoice_number FROM src_sales_order WHERE invoice_number IS NOT NULL
      GROUP BY invoice_number HAVING count(*) > 1)""")
def q_val_uniqueness(spark, sf_dir):
    return checks.uniqueness(_src(spark, sf_dir))


@register("val_order_type", """
SELECT 'Source orders with an unknown order_type' AS check_name,
       count(*) FILTER (WHERE order_type NOT IN ('Parts', 'Service', 'Mixed')) AS issue_count
FROM src_sales_order""")
def q_val_order_type(spark, sf_dir):
    return checks.order_type_check(_src(spark, sf_dir))


@register("pipeline_summary", """
WITH ok AS (
    SELECT coalesce(abs((SELECT sum(total_amount) FROM src_sales_order)
                        - (SELECT sum(total_amount) FROM w_fact)) < 0.01, false)
           AND (SELECT count(*) FROM src_sales_order o
                WHERE NOT EXISTS (SELECT 1 FROM w_fact f WHERE f.order_id = o.order_id)) = 0
           AS passed)
SELECT 'sales_order_fact' AS table_name, (SELECT count(*) FROM w_fact) AS row_count, passed FROM ok
UNION ALL SELECT 'sales_order_line_items', (SELECT count(*) FROM w_lines), passed FROM ok
UNION ALL SELECT 'service_parts_catalog', (SELECT count(*) FROM w_catalog), passed FROM ok""")
def q_pipeline_summary(spark, sf_dir):
    result = run_pipeline(spark, _src(spark, sf_dir), scratch_path(spark, "pipeline"),
                          run_date=RUN_DATE)
    return summary_frame(spark, result)


# ------------------------------------------------------- 2.10 access paths
def _fact_laid(spark, sf_dir):
    return _laid_out(spark, sf_dir, "sales_order_fact")


def _lines_laid(spark, sf_dir):
    return _laid_out(spark, sf_dir, "sales_order_line_items")


def _catalog_laid(spark, sf_dir):
    return _laid_out(spark, sf_dir, "service_parts_catalog")


@register("fact_by_order", """
SELECT * FROM w_fact f
WHERE f.order_id IN (SELECT order_id FROM w_lines WHERE line_item_type = 'SERVICE')""")
def q_fact_by_order(spark, sf_dir):
    probe = _lines_laid(spark, sf_dir).where(F.col("line_item_type") == "SERVICE")
    return _looked_up(spark, sf_dir, "sales_order_fact", "order_id", probe)


@register("fact_by_customer", """
SELECT * FROM w_fact f
WHERE f.customer_id IN (SELECT customer_id FROM src_customers WHERE phone IS NULL)""")
def q_fact_by_customer(spark, sf_dir):
    probe = _src(spark, sf_dir).customers.where(F.col("phone").isNull())
    return _looked_up(spark, sf_dir, "sales_order_fact", "customer_id", probe, clustered=True)


@register("fact_by_date_range", f"""
SELECT * FROM w_fact
WHERE order_date >= TIMESTAMP '{FACT_RANGE[0]}' AND order_date < TIMESTAMP '{FACT_RANGE[1]}'""")
def q_fact_by_date_range(spark, sf_dir):
    return _wide_cols(access.by_date_range(_fact_laid(spark, sf_dir), *FACT_RANGE),
                      "sales_order_fact")


@register("fact_by_invoice", f"""
SELECT * FROM w_fact f
WHERE f.invoice_number IN (SELECT invoice_number FROM w_lines WHERE quantity = {MAX_QUANTITY})""")
def q_fact_by_invoice(spark, sf_dir):
    probe = _lines_laid(spark, sf_dir).where(F.col("quantity") == MAX_QUANTITY)
    return _looked_up(spark, sf_dir, "sales_order_fact", "invoice_number", probe)


@register("fact_by_status", f"SELECT * FROM w_fact WHERE status = '{LOOKUP_STATUS}'")
def q_fact_by_status(spark, sf_dir):
    return _wide_cols(access.by_values(_fact_laid(spark, sf_dir), "status", [LOOKUP_STATUS]),
                      "sales_order_fact")


@register("fact_by_state_city",
          f"SELECT * FROM w_fact WHERE state = '{LOOKUP_STATE}' AND city = '{LOOKUP_CITY}'")
def q_fact_by_state_city(spark, sf_dir):
    found = lookup_values(spark, _curve_root(spark, sf_dir, "sales_order_fact"), clustering.clustered_name("sales_order_fact"),
                          {"state": [LOOKUP_STATE], "city": [LOOKUP_CITY]})
    return _wide_cols(found, "sales_order_fact")


@register("lines_by_type", "SELECT * FROM w_lines WHERE line_item_type = 'SERVICE'")
def q_lines_by_type(spark, sf_dir):
    return _wide_cols(access.by_values(_lines_laid(spark, sf_dir), "line_item_type", ["SERVICE"]),
                      "sales_order_line_items")


@register("lines_by_order", f"""
SELECT * FROM w_lines l
WHERE l.order_id IN (SELECT order_id FROM w_fact WHERE total_line_items >= {BIG_ORDER_LINES})""")
def q_lines_by_order(spark, sf_dir):
    probe = _fact_laid(spark, sf_dir).where(F.col("total_line_items") >= BIG_ORDER_LINES)
    return _looked_up(spark, sf_dir, "sales_order_line_items", "order_id", probe)


@register("lines_by_customer", """
SELECT * FROM w_lines l
WHERE l.customer_id IN (SELECT customer_id FROM src_customers WHERE phone IS NULL)""")
def q_lines_by_customer(spark, sf_dir):
    probe = _src(spark, sf_dir).customers.where(F.col("phone").isNull())
    return _looked_up(spark, sf_dir, "sales_order_line_items", "customer_id", probe, clustered=True)


@register("lines_by_date_range", f"""
SELECT * FROM w_lines
WHERE order_date >= TIMESTAMP '{LINES_RANGE[0]}' AND order_date < TIMESTAMP '{LINES_RANGE[1]}'""")
def q_lines_by_date_range(spark, sf_dir):
    return _wide_cols(access.by_date_range(_lines_laid(spark, sf_dir), *LINES_RANGE),
                      "sales_order_line_items")


@register("lines_by_item", f"""
SELECT * FROM w_lines l
WHERE l.item_code IN (SELECT sku FROM src_auto_parts WHERE vendor = '{LOOKUP_VENDOR}')""")
def q_lines_by_item(spark, sf_dir):
    probe = (_src(spark, sf_dir).auto_parts.where(F.col("vendor") == LOOKUP_VENDOR)
             .select(F.col("sku").alias("item_code")))
    return _looked_up(spark, sf_dir, "sales_order_line_items", "item_code", probe)


@register("lines_by_state", f"SELECT * FROM w_lines WHERE state = '{LOOKUP_LINE_STATE}'")
def q_lines_by_state(spark, sf_dir):
    return _looked_up(spark, sf_dir, "sales_order_line_items", "state", [LOOKUP_LINE_STATE], clustered=True)


@register("revenue_by_type_and_day", """
SELECT line_item_type, CAST(order_date AS DATE) AS order_day, count(*) AS line_count,
       CAST(sum(line_total) AS DECIMAL(22,2)) AS total_revenue
FROM w_lines GROUP BY ALL""")
def q_revenue_by_type_and_day(spark, sf_dir):
    return access.revenue_by_type_and_day(_lines_laid(spark, sf_dir))


@register("catalog_by_service", """
SELECT * FROM w_catalog c
WHERE c.serviceid IN (SELECT serviceid FROM src_service WHERE labor_cost < 0)""")
def q_catalog_by_service(spark, sf_dir):
    probe = _src(spark, sf_dir).service.where(F.col("labor_cost") < 0)
    return _looked_up(spark, sf_dir, "service_parts_catalog", "serviceid", probe)


@register("catalog_by_sku", f"""
SELECT * FROM w_catalog c
WHERE c.sku IN (SELECT sku FROM src_auto_parts WHERE price >= {EXPENSIVE_PART_PRICE})""")
def q_catalog_by_sku(spark, sf_dir):
    probe = _src(spark, sf_dir).auto_parts.where(
        F.col("price") >= F.lit(EXPENSIVE_PART_PRICE).cast("decimal(10,2)"))
    return _looked_up(spark, sf_dir, "service_parts_catalog", "sku", probe)


@register("catalog_by_category", f"SELECT * FROM w_catalog WHERE category = '{LOOKUP_CATEGORY}'")
def q_catalog_by_category(spark, sf_dir):
    return _wide_cols(access.by_values(_catalog_laid(spark, sf_dir), "category",
                                       [LOOKUP_CATEGORY]), "service_parts_catalog")


@register("catalog_by_vendor", f"SELECT * FROM w_catalog WHERE vendor = '{LOOKUP_VENDOR}'")
def q_catalog_by_vendor(spark, sf_dir):
    return _wide_cols(access.by_values(_catalog_laid(spark, sf_dir), "vendor", [LOOKUP_VENDOR]),
                      "service_parts_catalog")


TOP_ORDERS, TOP_ITEMS = 20, 20


def _top_orders(spark, sf_dir) -> DataFrame:
    """The orders of the highest totals: the probe of the narrow lookups."""
    fact = _fact_laid(spark, sf_dir).select("order_id", "invoice_number", "customer_id", "total_amount")
    return fact.orderBy(F.col("total_amount").desc_nulls_last(), "order_id").limit(TOP_ORDERS)


_TOP_ORDERS_SQL = f"""(SELECT * FROM w_fact ORDER BY total_amount DESC NULLS LAST, order_id LIMIT {TOP_ORDERS})"""


@register("fact_of_top_invoices",
          f"SELECT * FROM w_fact WHERE invoice_number IN (SELECT invoice_number FROM {_TOP_ORDERS_SQL})")
def q_fact_of_top_invoices(spark, sf_dir):
    return _looked_up(spark, sf_dir, "sales_order_fact", "invoice_number", _top_orders(spark, sf_dir))


@register("fact_of_top_customers",
          f"SELECT * FROM w_fact WHERE customer_id IN (SELECT customer_id FROM {_TOP_ORDERS_SQL})")
def q_fact_of_top_customers(spark, sf_dir):
    return _looked_up(spark, sf_dir, "sales_order_fact", "customer_id", _top_orders(spark, sf_dir), clustered=True)


@register("lines_of_top_orders",
          f"SELECT * FROM w_lines WHERE order_id IN (SELECT order_id FROM {_TOP_ORDERS_SQL})")
def q_lines_of_top_orders(spark, sf_dir):
    return _looked_up(spark, sf_dir, "sales_order_line_items", "order_id", _top_orders(spark, sf_dir))


@register("lines_of_top_items", f"""
SELECT * FROM w_lines
WHERE item_code IN (SELECT sku FROM src_auto_parts ORDER BY price DESC NULLS LAST, sku LIMIT {TOP_ITEMS})""")
def q_lines_of_top_items(spark, sf_dir):
    probe = (_src(spark, sf_dir).auto_parts.orderBy(F.col("price").desc_nulls_last(), "sku").limit(TOP_ITEMS)
             .select(F.col("sku").alias("item_code")))
    return _looked_up(spark, sf_dir, "sales_order_line_items", "item_code", probe)


# ------------------------------------------------------------ 2.12 extensions
_TRUE_QTY_SQL = """
WITH p AS (SELECT order_id, count(DISTINCT line_item_id) AS n, sum(quantity) AS q
           FROM src_sales_order_parts GROUP BY order_id),
     s AS (SELECT order_id, count(DISTINCT line_item_id) AS n, sum(quantity) AS q
           FROM src_sales_order_services GROUP BY order_id)
SELECT o.order_id, o.invoice_number, o.order_date, o.order_type, o.status, o.payment_method,
       c.customer_id, c.first_name, c.last_name, c.email, c.phone, c.city, c.state, c.zip_code,
       o.subtotal, o.tax, o.total_amount,
       coalesce(p.n, 0) AS parts_line_count, coalesce(s.n, 0) AS services_line_count,
       CAST(coalesce(p.q, 0) AS BIGINT) AS total_parts_quantity,
       CAST(coalesce(s.q, 0) AS BIGINT) AS total_services_quantity,
       coalesce(p.n, 0) + coalesce(s.n, 0) AS total_line_items
FROM src_sales_order o JOIN src_customers c ON c.customer_id = o.customer_id
LEFT JOIN p ON p.order_id = o.order_id LEFT JOIN s ON s.order_id = o.order_id"""


@register("sales_order_fact_true_qty", _TRUE_QTY_SQL)
def q_sales_order_fact_true_qty(spark, sf_dir):
    return sales_order_fact(_src(spark, sf_dir), true_quantities=True)


@register("incremental_refresh_equals_full", "SELECT * FROM w_fact")
def q_incremental_refresh_equals_full(spark, sf_dir):
    src = _src(spark, sf_dir)
    root = scratch_path(spark, "refresh")
    sinks.write_version(sales_order_fact(snapshot_before(src, REFRESH_CUTOFF)), root,
                        "sales_order_fact")
    current = sinks.read_current(spark, root, "sales_order_fact", WIDE["sales_order_fact"])
    refreshed = refresh_fact(src, current, changed_since(src, REFRESH_CUTOFF))
    sinks.write_version(refreshed, root, "sales_order_fact")
    return sinks.read_current(spark, root, "sales_order_fact", WIDE["sales_order_fact"])


DELETED_ID = 10_000_000_000  # added to the ids of the orders that the refresh finds deleted


def _in_month(column: str, month: str):
    return F.date_format(column, "yyyy-MM") == month


def _earlier_sources(src) -> tuple:
    """The sources as an earlier load may have left them, and the orders changed since: later orders not there yet, a
    month of orders dated two months before, a month without dates, a month (2031-05) of orders deleted since, and
    orders that had one service line, removed since."""
    orders, ts = src.sales_order, F.lit(REFRESH_CUTOFF).cast("timestamp_ntz")
    new = orders.where(F.col("created_at") >= ts).select("order_id")
    moved, undated = _in_month("order_date", "1996-01"), _in_month("order_date", "1996-02")
    at = (F.when(moved, F.expr("order_date - INTERVAL '2' MONTH")).when(undated, F.lit(None).cast("timestamp_ntz"))
          .otherwise(F.col("order_date")))
    deleted = (orders.where(_in_month("order_date", "1996-03")).withColumn("order_id", F.col("order_id") + DELETED_ID)
               .withColumn("order_date", F.lit("2031-05-05").cast("timestamp_ntz")))
    bare = (orders.where(_in_month("order_date", "1996-05")).select("order_id")
            .join(src.sales_order_services.select("order_id"), "order_id", "left_anti"))
    extra = (bare.unionByName(deleted.select("order_id"))
             .select(F.concat(F.lit("gone-"), "order_id").alias("line_item_id"), "order_id",
                     F.lit("SVC-000001").alias("serviceid"), F.lit(2).alias("quantity"),
                     F.lit("20.00").cast("decimal(12,2)").alias("line_total"), F.lit(30).alias("labor_minutes"),
                     F.lit("12.00").cast("decimal(10,2)").alias("labor_cost"), F.lit("8.00").cast("decimal(10,2)").alias("parts_cost")))
    before = src.with_tables(
        sales_order=orders.join(new, "order_id", "left_anti").withColumn("order_date", at).select(*orders.columns)
        .unionByName(deleted), sales_order_services=src.sales_order_services.unionByName(extra))
    changed = (new.unionByName(orders.where(moved | undated).select("order_id")).unionByName(deleted.select("order_id"))
               .unionByName(bare))
    return before, changed


def _refreshed_root(spark, sf_dir) -> str:
    """Tables of the earlier sources, stored with a rollup state and then refreshed by partitions."""
    key = _folder_state(spark, sf_dir)
    with _LAYOUT_LOCK:
        if key not in _REFRESH_ROOTS:
            root, src = scratch_path(spark, "partition-refresh"), _src(spark, sf_dir)
            before, changed = _earlier_sources(src)
            for name, build in ORDER_TABLES.items():
                layouts.write_layout(build(before), root, name)
            write_rollups(layouts.read_layout(spark, root, "sales_order_fact"), root)
            refresh_partitions(spark, src, root, changed)
            _REFRESH_ROOTS[key] = root
        return _REFRESH_ROOTS[key]


@register("partition_refresh_equals_full", "SELECT * FROM w_fact")
def q_partition_refresh_equals_full(spark, sf_dir):
    return sinks.read_current(spark, _refreshed_root(spark, sf_dir), "sales_order_fact", WIDE["sales_order_fact"])


@register("partition_refresh_lines_equals_full", "SELECT * FROM w_lines")
def q_partition_refresh_lines_equals_full(spark, sf_dir):
    return sinks.read_current(spark, _refreshed_root(spark, sf_dir), "sales_order_line_items",
                              WIDE["sales_order_line_items"])


def _rollup_sql(expr: str, name: str) -> str:
    return f"""
SELECT {expr} AS {name}, count(*) AS order_count,
       CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue,
       CAST(sum(subtotal) AS DECIMAL(22,2)) AS total_subtotal,
       CAST(sum(tax) AS DECIMAL(22,2)) AS total_tax,
       CAST(sum(parts_line_count) AS BIGINT) AS parts_lines,
       CAST(sum(services_line_count) AS BIGINT) AS services_lines
FROM w_fact GROUP BY 1"""


@register("daily_rollup", _rollup_sql("CAST(order_date AS DATE)", "order_day"))
def q_daily_rollup(spark, sf_dir):
    return reports.daily_rollup(_fact(spark, sf_dir))


@register("monthly_rollup", _rollup_sql("CAST(date_trunc('month', order_date) AS DATE)",
                                        "order_month"))
def q_monthly_rollup(spark, sf_dir):
    return reports.monthly_rollup(_fact(spark, sf_dir))


@register("rollup_delta_equals_full", "SELECT 'day' AS unit, order_day AS period, * EXCLUDE (order_day) FROM ("
          + _rollup_sql("CAST(order_date AS DATE)", "order_day") + ")\nUNION ALL SELECT 'month', * FROM ("
          + _rollup_sql("CAST(date_trunc('month', order_date) AS DATE)", "order_month") + ")")
def q_rollup_delta_equals_full(spark, sf_dir):
    state = sinks.read_current(spark, _refreshed_root(spark, sf_dir), ROLLUPS)
    day, month = (rollups.rollup(state, unit).withColumnRenamed(f"order_{unit}", "period").withColumn("unit", F.lit(unit))
                  for unit in rollups.UNITS)
    return day.unionByName(month)


@register("fact_with_etl_timestamp",
          f"SELECT *, TIMESTAMP '{RUN_TS}' AS etl_timestamp FROM w_fact")
def q_fact_with_etl_timestamp(spark, sf_dir):
    return reports.with_etl_timestamp(_fact(spark, sf_dir), RUN_TS)


@register("csv_gzip_roundtrip", "SELECT * FROM w_fact")
def q_csv_gzip_roundtrip(spark, sf_dir):
    fact = _fact(spark, sf_dir).withColumns(
        {"order_year": F.year("order_date"), "order_month": F.month("order_date")})
    ok, path = sinks.export_csv(fact, scratch_path(spark, "csvgz"), "sales_order_fact",
                                RUN_DATE, compression="gzip",
                                partition_by=("order_year", "order_month"))
    if not ok:
        raise RuntimeError("gzip CSV export failed")
    return _wide_cols(sinks.read_csv(spark, path, WIDE["sales_order_fact"]), "sales_order_fact")


@register("fact_masked", """
SELECT * REPLACE (
    sha256('widelines:' || split_part(email, '@', 1)) || '@' || split_part(email, '@', 2) AS email,
    regexp_replace(substr(phone, 1, greatest(length(phone) - 4, 0)), '[0-9]', 'X', 'g')
        || substr(phone, greatest(length(phone) - 3, 1), 4) AS phone,
    substr(last_name, 1, 1) || '.' AS last_name)
FROM w_fact""")
def q_fact_masked(spark, sf_dir):
    return reports.masked_fact(_fact(spark, sf_dir))


@register("customer_order_history", """
SELECT customer_id, order_id, order_date, invoice_number, count(*) AS line_count,
       count(*) FILTER (WHERE line_item_type = 'PART') AS part_lines,
       count(*) FILTER (WHERE line_item_type = 'SERVICE') AS service_lines,
       CAST(sum(line_total) AS DECIMAL(22,2)) AS order_line_total
FROM w_lines GROUP BY ALL""")
def q_customer_order_history(spark, sf_dir):
    return reports.customer_order_history(_lines(spark, sf_dir))


@register("revenue_by_customer_product", """
SELECT customer_id, line_item_type, item_code, count(*) AS line_count,
       CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(line_total) AS DECIMAL(22,2)) AS total_revenue
FROM w_lines GROUP BY ALL""")
def q_revenue_by_customer_product(spark, sf_dir):
    return reports.revenue_by_customer_product(_lines(spark, sf_dir))


@register("revenue_by_type", """
SELECT line_item_type, item_description, count(*) AS line_count,
       CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(line_total) AS DECIMAL(22,2)) AS total_revenue
FROM w_lines GROUP BY ALL""")
def q_revenue_by_type(spark, sf_dir):
    return reports.revenue_by_type(_lines(spark, sf_dir))


@register("sales_by_geography", """
SELECT state, city, count(*) AS order_count, count(DISTINCT customer_id) AS customer_count,
       CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue
FROM w_fact GROUP BY ALL""")
def q_sales_by_geography(spark, sf_dir):
    return reports.sales_by_geography(_fact(spark, sf_dir))


@register("parts_demand", """
SELECT c.sku, c.part_name, c.vendor,
       CAST(sum(CAST(l.quantity AS BIGINT) * c.parts_quantity_required) AS BIGINT)
           AS units_required,
       CAST(count(*) AS BIGINT) AS service_lines,
       count(DISTINCT c.serviceid) AS services_using_part
FROM w_lines l JOIN w_catalog c ON c.serviceid = l.item_code
WHERE l.line_item_type = 'SERVICE'
GROUP BY ALL""")
def q_parts_demand(spark, sf_dir):
    src = _src(spark, sf_dir)
    return reports.parts_demand(sales_order_line_items(src),
                                service_parts_catalog(src, ordered=False))


@register("order_mix", """
SELECT CASE WHEN parts_line_count > 0 AND services_line_count > 0 THEN 'both'
            WHEN parts_line_count > 0 THEN 'parts_only'
            WHEN services_line_count > 0 THEN 'services_only'
            ELSE 'none' END AS order_mix,
       count(*) AS order_count, CAST(sum(total_amount) AS DECIMAL(22,2)) AS total_revenue
FROM w_fact GROUP BY 1""")
def q_order_mix(spark, sf_dir):
    return reports.order_mix(_fact(spark, sf_dir))


@register("services_without_parts", """
SELECT * FROM src_service s
WHERE NOT EXISTS (SELECT 1 FROM src_service_parts sp WHERE sp.serviceid = s.serviceid)""")
def q_services_without_parts(spark, sf_dir):
    return services_without_parts(_src(spark, sf_dir))


@register("normalized_equals_wide", """
WITH n AS (SELECT c.state, count(*) AS normalized_orders,
                  CAST(sum(o.total_amount) AS DECIMAL(22,2)) AS normalized_revenue
           FROM src_sales_order o JOIN src_customers c ON c.customer_id = o.customer_id
           GROUP BY c.state),
     w AS (SELECT state, count(*) AS wide_orders,
                  CAST(sum(total_amount) AS DECIMAL(22,2)) AS wide_revenue
           FROM w_fact GROUP BY state)
SELECT coalesce(n.state, w.state) AS state, normalized_orders, normalized_revenue,
       wide_orders, wide_revenue,
       coalesce(normalized_orders = wide_orders AND normalized_revenue = wide_revenue, false)
           AS equal
FROM n FULL JOIN w ON n.state = w.state""")
def q_normalized_equals_wide(spark, sf_dir):
    src = _src(spark, sf_dir)
    return reports.normalized_equals_wide(src, sales_order_fact(src))


@register("normalized_wide_row_diff", f"""
WITH t AS ({_TRUE_QTY_SQL})
SELECT 'left' AS side, * FROM (SELECT * FROM w_fact EXCEPT ALL SELECT * FROM t)
UNION ALL SELECT 'right', * FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM w_fact)""")
def q_normalized_wide_row_diff(spark, sf_dir):
    """Rows of the stored wide fact that differ from the normalised tables' own sums (quantities that the defining
    join inflates), with those they should be."""
    wide = _wide_cols(_fact_laid(spark, sf_dir), "sales_order_fact")
    return reports.row_diff(wide, sales_order_fact(_src(spark, sf_dir), true_quantities=True), "order_id")


@register("wide_views", """
SELECT state, line_item_type, count(*) AS line_count,
       CAST(sum(line_total) AS DECIMAL(22,2)) AS total_revenue
FROM w_lines GROUP BY ALL""")
def q_wide_views(spark, sf_dir):
    src = _src(spark, sf_dir)
    wide = {"lines": sales_order_line_items(src), "fact": sales_order_fact(src)}
    # frames as arguments of the statement: no view of the session is replaced
    return spark.sql("""
        SELECT f.state, l.line_item_type, count(*) AS line_count, sum(l.line_total) AS total_revenue
        FROM {lines} l JOIN {fact} f ON f.order_id = l.order_id GROUP BY f.state, l.line_item_type""", **wide)
