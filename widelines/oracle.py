"""DuckDB oracle SQL for every registered query.

Each statement starts from the raw test tables (``region nation customer
supplier part orders lineitem``), derives the seven sources exactly as
``widelines.sources.fixtures`` does, builds the wide tables in their plain,
defining form (for the order fact that is the fan-out join grouped on every
column), and then asks its question.  Two DuckDB habits are neutralised:
decimal division runs in DOUBLE there, so unit prices use integer cents
with half-up rounding; and ``SUM``/``AVG`` widen to HUGEINT/DOUBLE there,
so every aggregate is cast to the type Spark produces.
"""

from __future__ import annotations

SOURCES_CTE = """
src_customers AS (
    SELECT c.c_custkey AS customer_id,
           split_part(c.c_name, '#', 1) AS first_name,
           split_part(c.c_name, '#', 2) AS last_name,
           'c' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
           CASE WHEN c.c_custkey % 10 = 0 THEN NULL
                ELSE '555-' || lpad(CAST(c.c_custkey AS VARCHAR), greatest(length(CAST(c.c_custkey AS VARCHAR)), 7)::INTEGER, '0') END AS phone,
           n.n_name AS city,
           r.r_name AS state,
           lpad(CAST(c.c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code
    FROM customer c
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    JOIN region r ON r.r_regionkey = n.n_regionkey
),
src_order_base AS (
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderstatus,
           CAST(o_totalprice AS DECIMAL(12,2)) AS subtotal
    FROM orders
),
src_sales_order AS (
    SELECT o_orderkey AS order_id,
           o_custkey AS customer_id,
           o_orderdate AS order_date,
           'INV-' || lpad(CAST(o_orderkey AS VARCHAR), greatest(length(CAST(o_orderkey AS VARCHAR)), 10)::INTEGER, '0') AS invoice_number,
           o_orderpriority AS payment_method,
           subtotal,
           CAST(round(subtotal * CAST(0.08 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS tax,
           CAST(subtotal + CAST(round(subtotal * CAST(0.08 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2))
                AS DECIMAL(12,2)) AS total_amount,
           CASE o_orderstatus WHEN 'F' THEN 'Parts' WHEN 'O' THEN 'Service' ELSE 'Mixed' END
               AS order_type,
           CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' ELSE 'Pending' END
               AS status,
           o_orderdate AS created_at,
           o_orderdate AS updated_at
    FROM src_order_base
),
src_lines AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
               || CAST(l_partkey AS VARCHAR) || '-'
               || CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS VARCHAR)
               AS line_item_id,
           l_orderkey AS order_id,
           'SKU-' || lpad(CAST(l_partkey AS VARCHAR), greatest(length(CAST(l_partkey AS VARCHAR)), 8)::INTEGER, '0') AS sku,
           'SVC-' || lpad(CAST(l_suppkey AS VARCHAR), greatest(length(CAST(l_suppkey AS VARCHAR)), 6)::INTEGER, '0') AS serviceid,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents,
           l_returnflag AS flag
    FROM lineitem
),
src_sales_order_parts AS (
    SELECT line_item_id, order_id, sku, quantity,
           CAST((cents * 2 + quantity) // (2 * NULLIF(quantity, 0)) * CAST(0.01 AS DECIMAL(3,2))
                AS DECIMAL(10,2)) AS unit_price,
           line_total, cents
    FROM src_lines WHERE flag <> 'R'
),
src_sales_order_services AS (
    SELECT line_item_id, order_id, serviceid, quantity, line_total,
           quantity * 15 AS labor_minutes,
           CAST(round(line_total * CAST(0.60 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS labor_cost,
           CAST(line_total - round(line_total * CAST(0.60 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2))
               AS parts_cost,
           cents
    FROM src_lines WHERE flag = 'R'
),
src_auto_parts AS (
    SELECT 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), greatest(length(CAST(p_partkey AS VARCHAR)), 8)::INTEGER, '0') AS sku,
           p_name AS name, p_type AS description,
           CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS vendor
    FROM part
),
src_service AS (
    SELECT 'SVC-' || lpad(CAST(s.s_suppkey AS VARCHAR), greatest(length(CAST(s.s_suppkey AS VARCHAR)), 6)::INTEGER, '0') AS serviceid,
           s.s_name AS service, n.n_name AS category,
           CAST(30 + (s.s_suppkey % 8) * 15 AS INTEGER) AS labor_minutes,
           CAST(s.s_acctbal AS DECIMAL(19,2)) AS labor_cost
    FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
),
src_service_parts AS (
    SELECT serviceid, sku, CAST(sum(quantity) AS INTEGER) AS quantity
    FROM src_lines GROUP BY serviceid, sku
)"""

WIDE_CTE = """
w_fact AS (
    SELECT o.order_id, o.invoice_number, o.order_date, o.order_type, o.status, o.payment_method,
           c.customer_id, c.first_name, c.last_name, c.email, c.phone, c.city, c.state, c.zip_code,
           o.subtotal, o.tax, o.total_amount,
           count(DISTINCT p.line_item_id) AS parts_line_count,
           count(DISTINCT s.line_item_id) AS services_line_count,
           CAST(coalesce(sum(p.quantity), 0) AS BIGINT) AS total_parts_quantity,
           CAST(coalesce(sum(s.quantity), 0) AS BIGINT) AS total_services_quantity,
           count(DISTINCT p.line_item_id) + count(DISTINCT s.line_item_id) AS total_line_items
    FROM src_sales_order o
    JOIN src_customers c ON c.customer_id = o.customer_id
    LEFT JOIN src_sales_order_parts p ON p.order_id = o.order_id
    LEFT JOIN src_sales_order_services s ON s.order_id = o.order_id
    GROUP BY ALL
),
w_part_lines AS (
    SELECT 'PART' AS line_item_type, p.line_item_id, o.order_id, o.invoice_number, o.order_date,
           o.status AS order_status, c.customer_id,
           c.first_name || ' ' || c.last_name AS customer_name, c.email AS customer_email,
           c.city, c.state, p.sku AS item_code, a.name AS item_name,
           a.description AS item_description, p.quantity, p.unit_price, p.line_total, a.vendor,
           CAST(NULL AS INTEGER) AS labor_minutes, CAST(NULL AS DECIMAL(10,2)) AS labor_cost,
           CAST(NULL AS DECIMAL(10,2)) AS parts_cost
    FROM src_sales_order_parts p
    JOIN src_sales_order o ON o.order_id = p.order_id
    JOIN src_customers c ON c.customer_id = o.customer_id
    JOIN src_auto_parts a ON a.sku = p.sku
),
w_service_lines AS (
    SELECT 'SERVICE' AS line_item_type, v.line_item_id, o.order_id, o.invoice_number,
           o.order_date, o.status AS order_status, c.customer_id,
           c.first_name || ' ' || c.last_name AS customer_name, c.email AS customer_email,
           c.city, c.state, v.serviceid AS item_code, s.service AS item_name,
           s.category AS item_description, v.quantity,
           CAST((v.cents * 2 + v.quantity) // (2 * NULLIF(v.quantity, 0))
                * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price,
           v.line_total, CAST(NULL AS VARCHAR) AS vendor, v.labor_minutes, v.labor_cost,
           v.parts_cost
    FROM src_sales_order_services v
    JOIN src_sales_order o ON o.order_id = v.order_id
    JOIN src_customers c ON c.customer_id = o.customer_id
    JOIN src_service s ON s.serviceid = v.serviceid
),
w_lines AS (
    SELECT * FROM w_part_lines
    UNION ALL
    SELECT * FROM w_service_lines
),
w_catalog AS (
    SELECT s.serviceid, s.service, s.category, s.labor_minutes, s.labor_cost, sp.sku,
           a.name AS part_name, a.description AS part_description,
           sp.quantity AS parts_quantity_required, a.price AS part_unit_price,
           CAST(sp.quantity * a.price AS DECIMAL(21,2)) AS total_parts_cost,
           CAST(s.labor_cost + sp.quantity * a.price AS DECIMAL(22,2)) AS total_service_cost,
           a.vendor
    FROM src_service s
    JOIN src_service_parts sp ON sp.serviceid = s.serviceid
    JOIN src_auto_parts a ON a.sku = sp.sku
)"""


def with_ctes(body: str) -> str:
    """Prefix a query body with the source and wide-table CTEs.

    A body with its own ``WITH`` list has its CTEs appended to ours.
    """
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return "WITH" + SOURCES_CTE + "," + WIDE_CTE + ",\n" + body[5:] + "\n"
    return "WITH" + SOURCES_CTE + "," + WIDE_CTE + "\n" + body + "\n"
