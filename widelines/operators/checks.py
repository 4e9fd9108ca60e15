"""Data-quality checks: one DataFrame per check group, never a driver loop.

Counting checks return rows of ``(check_name, issue_count)``; total checks
return ``(source, <total columns>)``, labelled by column, never by row
position.  Every group that looks at one table does so in a single pass
(conditional aggregates) and turns the one wide row into labelled rows with
``stack``, instead of one scan per UNION ALL branch.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from widelines.functions.money import TOLERANCE, within_tolerance
from widelines.operators.fact import line_metrics
from widelines.sources.model import Sources

# Check labels of the original job's report, in its order.
ROW_COUNT_LABELS = [
    "Source: sales_order",
    "Source: sales_order_parts",
    "Source: sales_order_services",
    "Source: customers",
    "Denormalized: sales_order_fact",
    "Denormalized: sales_order_line_items",
    "Denormalized: service_parts_catalog",
]
FINANCIAL_LABELS = ["Source (sales_order)", "Denormalized (sales_order_fact)"]
LINE_TOTAL_LABELS = ["Source: Parts", "Source: Services", "Denormalized: Parts",
                     "Denormalized: Services"]
ORPHAN_LABELS = ["Orphaned orders in sales_order_fact", "Missing customers in sales_order_fact",
                 "Orphaned line items"]
NULL_LABELS = ["sales_order_fact: NULL order_id", "sales_order_fact: NULL customer_id",
               "sales_order_fact: NULL total_amount", "sales_order_line_items: NULL order_id",
               "sales_order_line_items: NULL line_total"]
NEGATIVE_LABELS = ["Negative quantities in line items", "Negative prices in line items"]
ORDER_TYPES = ("Parts", "Service", "Mixed")
ORDER_TYPE_LABEL = "Source orders with an unknown order_type"
UNIQUE_KEYS = ("order_id", "invoice_number")
MISMATCH_LABELS = ["Orders with mismatched parts count", "Orders with mismatched services count"]


def _count_rows(df: DataFrame, label: str, label_col: str = "table_name",
                value_col: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(value_col)).select(
        F.lit(label).alias(label_col), value_col)


def _stack(one_row: DataFrame, pairs: list[tuple[str, str]], label_col: str,
           value_col: str) -> DataFrame:
    """One wide row of values -> ``len(pairs)`` labelled rows (label, value)."""
    args = ", ".join(f"'{label}', `{col}`" for label, col in pairs)
    return one_row.selectExpr(f"stack({len(pairs)}, {args}) AS (`{label_col}`, `{value_col}`)")


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def row_counts(src: Sources, fact: DataFrame, lines: DataFrame, catalog: DataFrame) -> DataFrame:
    """VAL-01: row counts of four sources and three wide tables."""
    tables = [src.sales_order, src.sales_order_parts, src.sales_order_services, src.customers,
              fact, lines, catalog]
    return _union_all([_count_rows(t.select(F.lit(1).alias("one")), label)
                       for t, label in zip(tables, ROW_COUNT_LABELS)])


def _money_totals(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.sum("total_amount").alias("total_revenue"),
        F.sum("subtotal").alias("total_subtotal"),
        F.sum("tax").alias("total_tax"),
    ).select(F.lit(label).alias("source"), "total_revenue", "total_subtotal", "total_tax")


def financial_totals(src: Sources, fact: DataFrame) -> DataFrame:
    """VAL-02: revenue, subtotal and tax of the source orders and of the fact."""
    return _money_totals(src.sales_order, FINANCIAL_LABELS[0]).unionByName(
        _money_totals(fact, FINANCIAL_LABELS[1]))


def line_totals(src: Sources, lines: DataFrame) -> DataFrame:
    """VAL-03: line totals of both source tables and both halves of the line table."""
    source_parts = src.sales_order_parts.agg(F.sum("line_total").alias("t"))
    source_services = src.sales_order_services.agg(F.sum("line_total").alias("t"))
    wide = lines.agg(
        F.sum(F.when(F.col("line_item_type") == "PART", F.col("line_total"))).alias("p"),
        F.sum(F.when(F.col("line_item_type") == "SERVICE", F.col("line_total"))).alias("s"),
    )
    return _union_all([
        source_parts.select(F.lit(LINE_TOTAL_LABELS[0]).alias("source"),
                            F.col("t").alias("total_line_amount")),
        source_services.select(F.lit(LINE_TOTAL_LABELS[1]).alias("source"),
                               F.col("t").alias("total_line_amount")),
        _stack(wide, [(LINE_TOTAL_LABELS[2], "p"), (LINE_TOTAL_LABELS[3], "s")],
               "source", "total_line_amount"),
    ])


def orphan_checks(src: Sources, fact: DataFrame, lines: DataFrame) -> DataFrame:
    """VAL-04: wide rows whose order or customer is missing from the sources (anti joins)."""
    order_keys = src.sales_order.select("order_id")
    customer_keys = src.customers.select("customer_id")
    checks = [
        fact.select("order_id").join(order_keys, "order_id", "left_anti"),
        fact.select("customer_id").join(customer_keys, "customer_id", "left_anti"),
        lines.select("order_id").join(order_keys, "order_id", "left_anti"),
    ]
    return _union_all([_count_rows(c, label, "check_name", "issue_count")
                       for c, label in zip(checks, ORPHAN_LABELS)])


def missing_from_fact(src: Sources, fact: DataFrame) -> DataFrame:
    """Source orders absent from the fact (the reverse anti join the orphan checks lack)."""
    missing = src.sales_order.select("order_id").join(fact.select("order_id"), "order_id",
                                                       "left_anti")
    return _count_rows(missing, "Source orders missing from sales_order_fact",
                       "check_name", "issue_count")


def _unknown_type() -> Column:
    """A NULL type passes, as it passes the source's CHECK."""
    return F.count_if(~F.col("order_type").isin(*ORDER_TYPES))


def order_type_check(src: Sources) -> DataFrame:
    """Source orders whose type is none of the three that the source's CHECK allows."""
    return src.sales_order.agg(_unknown_type().alias("issue_count")).select(
        F.lit(ORDER_TYPE_LABEL).alias("check_name"), "issue_count")


def uniqueness(src: Sources) -> DataFrame:
    """Keys of the source orders that several orders share (NULLs are not counted)."""
    return _union_all([_count_rows(src.sales_order.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1"),
                                   f"Repeated {key} in sales_order", "check_name", "issue_count")
                       for key in UNIQUE_KEYS])


def null_checks(fact: DataFrame, lines: DataFrame) -> DataFrame:
    """VAL-05/06: NULLs in critical columns, one pass per table."""
    f = fact.agg(
        F.count_if(F.col("order_id").isNull()).alias("a"),
        F.count_if(F.col("customer_id").isNull()).alias("b"),
        F.count_if(F.col("total_amount").isNull()).alias("c"),
    )
    li = lines.agg(
        F.count_if(F.col("order_id").isNull()).alias("d"),
        F.count_if(F.col("line_total").isNull()).alias("e"),
    )
    return _stack(f, list(zip(NULL_LABELS[:3], "abc")), "check_name", "issue_count").unionByName(
        _stack(li, list(zip(NULL_LABELS[3:], "de")), "check_name", "issue_count"))


def negative_checks(lines: DataFrame) -> DataFrame:
    """VAL-07: negative quantities and unit prices (NULLs are not counted)."""
    one = lines.agg(
        F.count_if(F.col("quantity") < 0).alias("q"),
        F.count_if(F.col("unit_price") < 0).alias("p"),
    )
    return _stack(one, list(zip(NEGATIVE_LABELS, "qp")), "check_name", "issue_count")


def source_line_counts(src: Sources) -> DataFrame:
    """AGG-10: distinct part and service line counts per source order (0 when none)."""
    parts = line_metrics(src.sales_order_parts.select("order_id", "line_item_id", "quantity"),
                         "parts")
    services = line_metrics(
        src.sales_order_services.select("order_id", "line_item_id", "quantity"), "services")
    zero = F.lit(0).cast("bigint")
    return (src.sales_order.select("order_id").distinct()
            .join(parts, "order_id", "left")
            .join(services, "order_id", "left")
            .select("order_id",
                    F.coalesce("parts_line_count", zero).alias("parts_count"),
                    F.coalesce("services_line_count", zero).alias("services_count")))


def count_mismatch(src: Sources, fact: DataFrame) -> DataFrame:
    """VAL-08: orders whose stored line counts differ from the sources (one join)."""
    joined = source_line_counts(src).join(
        fact.select("order_id", "parts_line_count", "services_line_count"), "order_id")
    one = joined.agg(
        F.count_if(F.col("parts_count") != F.col("parts_line_count")).alias("p"),
        F.count_if(F.col("services_count") != F.col("services_line_count")).alias("s"),
    )
    return _stack(one, list(zip(MISMATCH_LABELS, "ps")), "check_name", "issue_count")


def wide_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """VAL-09 / AGG-07: ``(table_name, row_count)`` of the wide tables."""
    return _union_all([_count_rows(df.select(F.lit(1).alias("one")), name)
                       for name, df in tables.items()])


def financial_check(src: Sources, fact: DataFrame) -> DataFrame:
    """VAL-10: source and fact revenue within 0.01; False when either is NULL.

    Both columns are tagged and summed in one aggregate over their union, so
    the two totals meet in one row without a join.
    """
    tagged = (src.sales_order.select(F.lit(0).alias("side"), "total_amount")
              .unionByName(fact.select(F.lit(1).alias("side"), "total_amount")))
    both = tagged.agg(
        F.sum(F.when(F.col("side") == 0, F.col("total_amount"))).alias("source_total"),
        F.sum(F.when(F.col("side") == 1, F.col("total_amount"))).alias("denormalized_total"),
    )
    return both.select(
        "source_total", "denormalized_total",
        within_tolerance("source_total", "denormalized_total").alias("passed"))


def financial_totals_pair(src: Sources, fact: DataFrame) -> DataFrame:
    """AGG-08: ``(source, total_revenue)`` for the source orders and the fact."""
    return (src.sales_order.agg(F.sum("total_amount").alias("total_revenue"))
            .select(F.lit("Source").alias("source"), "total_revenue")
            .unionByName(fact.agg(F.sum("total_amount").alias("total_revenue"))
                         .select(F.lit("Denormalized").alias("source"), "total_revenue")))


def all_issue_checks(src: Sources, fact: DataFrame, lines: DataFrame) -> DataFrame:
    """Every counting check in one frame; a clean build has all issue counts 0."""
    return _union_all([orphan_checks(src, fact, lines), missing_from_fact(src, fact),
                       order_type_check(src), null_checks(fact, lines), negative_checks(lines),
                       count_mismatch(src, fact)])


# ------------------------------------------------------------ reconciliation passes
# The pipeline runs every check above on each build.  Instead of one scan or
# join per check, it reconciles the wide tables against their sources in
# three joins, each followed by one aggregate:
#
# * fact side: the fact (with a customer-found marker) LEFT JOIN the source
#   orders carrying their recomputed line counts: orphans, missing customers,
#   NULLs, count mismatches and the fact's revenue;
# * source side: the source orders LEFT JOIN the fact's distinct keys: orders
#   missing from the fact, unknown order types and the source revenue, every
#   source row once;
# * lines: the lines LEFT JOIN the source order keys: orphans, NULLs, negatives.
#
# The counts equal the individual checks, NULL keys included (a NULL key
# matches nothing, as with NOT EXISTS), and duplicated rows on either side
# are counted as often as the individual checks count them.

FACT_COUNT_LABELS = [ORPHAN_LABELS[0], ORPHAN_LABELS[1], NULL_LABELS[0], NULL_LABELS[1],
                     NULL_LABELS[2], MISMATCH_LABELS[0], MISMATCH_LABELS[1]]
SOURCE_COUNT_LABELS = ["Source orders missing from sales_order_fact", ORDER_TYPE_LABEL]
LINE_COUNT_LABELS = [ORPHAN_LABELS[2], NULL_LABELS[3], NULL_LABELS[4], NEGATIVE_LABELS[0],
                     NEGATIVE_LABELS[1]]


def reconcile_fact(src: Sources, fact: DataFrame,
                   max_broadcast_rows: int = 200_000) -> DataFrame:
    """One row: the fact-level issue counts and the fact's revenue total."""
    customers = src.broadcast_if_small(
        src.customers.select("customer_id", F.lit(True).alias("_customer_found")),
        ("customers",), max_broadcast_rows)
    counts = source_line_counts(src).withColumn("_in_source", F.lit(True))
    j = (fact.select("order_id", "customer_id", "total_amount", "parts_line_count",
                     "services_line_count")
         .join(customers, "customer_id", "left")
         .join(counts, "order_id", "left"))
    found = F.col("_in_source").isNotNull()
    return j.agg(
        F.count_if(~found).alias("c0"),
        F.count_if(F.col("_customer_found").isNull()).alias("c1"),
        F.count_if(F.col("order_id").isNull()).alias("c2"),
        F.count_if(F.col("customer_id").isNull()).alias("c3"),
        F.count_if(F.col("total_amount").isNull()).alias("c4"),
        F.count_if(found & (F.col("parts_count") != F.col("parts_line_count"))).alias("c5"),
        F.count_if(found & (F.col("services_count") != F.col("services_line_count")))
        .alias("c6"),
        F.sum("total_amount").alias("denormalized_total"),
    )


def reconcile_source(src: Sources, fact: DataFrame) -> DataFrame:
    """One row: source orders missing from the fact or of an unknown type, and the source revenue total."""
    keys = fact.select("order_id").distinct().withColumn("_in_fact", F.lit(True))
    j = src.sales_order.select("order_id", "order_type", "total_amount").join(keys, "order_id", "left")
    return j.agg(
        F.count_if(F.col("_in_fact").isNull()).alias("c0"),
        _unknown_type().alias("c1"),
        F.sum("total_amount").alias("source_total"),
    )


def reconcile_lines(src: Sources, lines: DataFrame) -> DataFrame:
    """One row: the line-level issue counts."""
    keys = src.sales_order.select("order_id").distinct().withColumn("_order_found", F.lit(True))
    j = lines.select("order_id", "line_total", "quantity", "unit_price").join(
        keys, "order_id", "left")
    return j.agg(
        F.count_if(F.col("_order_found").isNull()).alias("c0"),
        F.count_if(F.col("order_id").isNull()).alias("c1"),
        F.count_if(F.col("line_total").isNull()).alias("c2"),
        F.count_if(F.col("quantity") < 0).alias("c3"),
        F.count_if(F.col("unit_price") < 0).alias("c4"),
    )


def reconciled_issues(fact_row, source_row, lines_row) -> dict[str, int]:
    """Labelled issue counts from the three reconciliation rows."""
    out = {}
    for labels, row in ((FACT_COUNT_LABELS, fact_row), (SOURCE_COUNT_LABELS, source_row),
                        (LINE_COUNT_LABELS, lines_row)):
        out.update({label: int(row[f"c{i}"]) for i, label in enumerate(labels)})
    return out


def reconciled_financial_ok(fact_row, source_row) -> bool:
    s, d = source_row["source_total"], fact_row["denormalized_total"]
    return s is not None and d is not None and abs(s - d) < Decimal(TOLERANCE)


def reconcile_counts(src: Sources, lines: DataFrame) -> DataFrame:
    """One row: source lines less stored lines (in number, and in cents) per type, and repeated keys of the orders.

    All zero when every source line is stored once and orders are unique, as the source's keys demand.
    """
    kinds = {"PART": src.sales_order_parts, "SERVICE": src.sales_order_services}

    def cents(name: str) -> Column:
        return F.coalesce(F.sum(F.round(F.col(name) * 100).cast("decimal(38,0)")), F.lit(0))

    stored = lines.groupBy(F.col("line_item_type").alias("kind")).agg(
        (-F.count("*")).alias("n"), (-cents("line_total")).alias("cents"))
    for kind, table in kinds.items():
        stored = stored.unionByName(table.agg(F.count("*").alias("n"), cents("line_total").alias("cents"))
                                    .withColumn("kind", F.lit(kind)))
    stack = "stack(2, concat(kind, ' lines: source less stored, n'), cast(n as decimal(38,0)), " \
            "concat(kind, ' lines: source less stored, cents'), cast(cents as decimal(38,0))) as (label, n)"
    found = stored.selectExpr(stack)
    for key in ("order_id", "invoice_number"):
        repeated = src.sales_order.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        found = found.unionByName(repeated.agg(F.count("*").cast("decimal(38,0)").alias("n"))
                                  .withColumn("label", F.lit(f"Repeated {key} in sales_order")))
    labels = [f"{kind} lines: source less stored, {c}" for kind in kinds for c in ("n", "cents")]
    labels += [f"Repeated {key} in sales_order" for key in ("order_id", "invoice_number")]
    return found.agg(*(F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)).alias(x) for x in labels))
