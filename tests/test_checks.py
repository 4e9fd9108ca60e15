"""Checks: literal cases of the original job's own tests and planted defects."""

from decimal import Decimal

from pyspark.sql import functions as F

from builders import customer, make_sources, order, part, svc
from widelines.operators import checks
from widelines.operators.catalog import service_parts_catalog
from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items
from widelines.plans import sinks
from widelines.schemas import SALES_ORDER_FACT


def _clean(spark):
    return make_sources(spark, customers=[customer(1), customer(2)],
                        orders=[order(1, 1), order(2, 2, total="216.00")],
                        parts=[part("p1", 1, 2), part("p2", 2, 1)],
                        services=[svc("s1", 1, 1)])


def _as_dict(df, key="check_name", value="issue_count"):
    return {r[key]: r[value] for r in df.collect()}


def test_clean_build_has_no_issues(spark):
    src = _clean(spark)
    fact, lines = sales_order_fact(src), sales_order_line_items(src)
    issues = _as_dict(checks.all_issue_checks(src, fact, lines))
    assert set(issues) >= set(checks.ORPHAN_LABELS + checks.NULL_LABELS + checks.NEGATIVE_LABELS
                              + checks.MISMATCH_LABELS)
    assert all(v == 0 for v in issues.values())
    assert checks.financial_check(src, fact).first().passed is True


def test_row_counts_labels_and_values(spark):
    src = _clean(spark)
    counts = _as_dict(checks.row_counts(src, sales_order_fact(src), sales_order_line_items(src),
                                        service_parts_catalog(src)), "table_name", "row_count")
    assert list(counts) == checks.ROW_COUNT_LABELS
    assert counts["Source: sales_order"] == 2 and counts["Denormalized: sales_order_line_items"] == 3


def test_planted_defects_are_counted_exactly(spark):
    src = _clean(spark)
    fact = sales_order_fact(src)
    lines = sales_order_line_items(src)
    f_rows = fact.collect()
    bad_fact = spark.createDataFrame(
        f_rows
        + [f_rows[0].asDict() | {"order_id": 77}]                        # orphan order
        + [f_rows[0].asDict() | {"customer_id": 55}]                     # missing customer
        + [f_rows[1].asDict() | {"order_id": None, "total_amount": None}]  # 2 NULLs
        + [f_rows[1].asDict() | {"parts_line_count": 9}],                # count mismatch
        SALES_ORDER_FACT)
    l_rows = lines.collect()
    bad_lines = spark.createDataFrame(
        l_rows
        + [l_rows[0].asDict() | {"order_id": 88}]                        # orphan line
        + [l_rows[0].asDict() | {"quantity": -1}]                        # negative qty
        + [l_rows[0].asDict() | {"unit_price": Decimal("-1.00")}]        # negative price
        + [l_rows[0].asDict() | {"line_total": None}],                   # NULL total
        lines.schema)
    issues = _as_dict(checks.all_issue_checks(src, bad_fact, bad_lines))
    # NOT EXISTS semantics: the NULL order id has no matching order either
    assert issues["Orphaned orders in sales_order_fact"] == 2
    assert issues["Missing customers in sales_order_fact"] == 1
    assert issues["Orphaned line items"] == 1
    assert issues["sales_order_fact: NULL order_id"] == 1
    assert issues["sales_order_fact: NULL total_amount"] == 1
    assert issues["sales_order_fact: NULL customer_id"] == 0
    assert issues["sales_order_line_items: NULL line_total"] == 1
    assert issues["Negative quantities in line items"] == 1
    assert issues["Negative prices in line items"] == 1
    assert issues["Orders with mismatched parts count"] == 1
    assert issues["Orders with mismatched services count"] == 0


def test_unknown_customer_fails_financial_check(spark):
    src = make_sources(spark, customers=[customer(1)], orders=[order(1, 1), order(2, 9)])
    fact = sales_order_fact(src)
    r = checks.financial_check(src, fact).first()
    assert r.passed is False and r.source_total - r.denormalized_total == Decimal("108.00")
    assert _as_dict(checks.missing_from_fact(src, fact))[
        "Source orders missing from sales_order_fact"] == 1


def _totals_check(spark, source, denorm):
    """Financial check over one-column frames holding the given totals."""
    schema = "total_amount decimal(12,3)"
    s = spark.createDataFrame([(Decimal(v),) for v in source], schema)
    d = spark.createDataFrame([(Decimal(v),) for v in denorm], schema)
    src = type("S", (), {"sales_order": s})()
    return checks.financial_check(src, d).first().passed


def test_original_tolerance_cases(spark):
    # literal cases of the original job's tests: equal, 50,000 off, inside 0.01
    assert _totals_check(spark, ["1000000.00"], ["1000000.00"]) is True
    assert _totals_check(spark, ["1000000.00"], ["950000.00"]) is False
    assert _totals_check(spark, ["1000000.005"], ["1000000.001"]) is True
    assert _totals_check(spark, ["1000000.00"], []) is False  # missing total -> False


def test_line_totals_match_sources(spark):
    src = _clean(spark)
    totals = _as_dict(checks.line_totals(src, sales_order_line_items(src)), "source",
                      "total_line_amount")
    assert totals["Source: Parts"] == totals["Denormalized: Parts"] == Decimal("20.00")
    assert totals["Source: Services"] == totals["Denormalized: Services"] == Decimal("20.00")


def test_table_row_count_minus_one_when_missing(spark, scratch):
    assert sinks.table_row_count(spark, scratch, "no_such_table") == -1
    sinks.write_version(spark.range(0).withColumn("x", F.lit(1)), scratch, "empty")
    assert sinks.table_row_count(spark, scratch, "empty") == 0


def test_reconciliation_equals_individual_checks(spark):
    """The pipeline's two-pass reconciliation gives exactly the individual checks."""
    src = _clean(spark)
    fact, lines = sales_order_fact(src), sales_order_line_items(src)
    f_rows, l_rows = fact.collect(), lines.collect()
    bad_fact = spark.createDataFrame(
        f_rows + [f_rows[0].asDict() | {"order_id": 77}]
        + [f_rows[0].asDict() | {"customer_id": 55, "order_id": 78}]
        + [f_rows[1].asDict() | {"order_id": None, "total_amount": None}]
        + [f_rows[1].asDict() | {"services_line_count": 9}], SALES_ORDER_FACT)
    bad_lines = spark.createDataFrame(
        l_rows + [l_rows[0].asDict() | {"order_id": None, "quantity": -2}]
        + [l_rows[0].asDict() | {"unit_price": Decimal("-1.00"), "line_total": None}],
        lines.schema)
    # source order 1 missing from the fact
    bad_fact = bad_fact.where("order_id IS NULL OR order_id <> 1")
    expected = _as_dict(checks.all_issue_checks(src, bad_fact, bad_lines))
    f_row = checks.reconcile_fact(src, bad_fact).first()
    s_row = checks.reconcile_source(src, bad_fact).first()
    got = checks.reconciled_issues(f_row, s_row, checks.reconcile_lines(src, bad_lines).first())
    assert got == expected
    assert sum(got.values()) > 0
    fin = checks.financial_check(src, bad_fact).first()
    assert (s_row.source_total, f_row.denormalized_total) == (fin.source_total,
                                                              fin.denormalized_total)
    assert checks.reconciled_financial_ok(f_row, s_row) is fin.passed is False


def test_repeated_keys_are_counted(spark):
    src = make_sources(spark, customers=[customer(1)], orders=[order(1, 1), order(2, 1), order(3, 1)])
    twice = src.sales_order.withColumn("invoice_number", F.when(F.col("order_id") < 3, "i"))
    src = src.with_tables(sales_order=twice.union(twice.where("order_id = 1")))
    assert _as_dict(checks.uniqueness(src)) == {"Repeated order_id in sales_order": 1,
                                               "Repeated invoice_number in sales_order": 1}
