"""Driver-side helpers that need no Spark session."""

import datetime as dt
import time
from decimal import Decimal

from widelines.operators import checks
from widelines.plans import sinks
from widelines.plans.layouts import LAYOUTS, writer_options
from widelines.schemas import WIDE


def _rows(fact=(0,) * len(checks.FACT_COUNT_LABELS), source=(0,) * len(checks.SOURCE_COUNT_LABELS),
          lines=(0,) * len(checks.LINE_COUNT_LABELS), s_total="10.00", d_total="10.00"):
    f = {f"c{i}": v for i, v in enumerate(fact)} | {"denormalized_total": d_total and Decimal(d_total)}
    s = {f"c{i}": v for i, v in enumerate(source)} | {"source_total": s_total and Decimal(s_total)}
    li = {f"c{i}": v for i, v in enumerate(lines)}
    return f, s, li


def test_reconciled_issue_labels_cover_every_check():
    f, s, li = _rows(fact=(1, 2, 3, 4, 5, 6, 7), source=(8, 14), lines=(9, 10, 11, 12, 13))
    issues = checks.reconciled_issues(f, s, li)
    assert issues["Orphaned orders in sales_order_fact"] == 1
    assert issues["Orders with mismatched services count"] == 7
    assert issues["Source orders missing from sales_order_fact"] == 8
    assert issues[checks.ORDER_TYPE_LABEL] == 14
    assert issues["Negative prices in line items"] == 13
    labels = set(checks.ORPHAN_LABELS + checks.NULL_LABELS + checks.NEGATIVE_LABELS
                 + checks.MISMATCH_LABELS)
    assert labels <= set(issues) and len(issues) == len(labels) + len(checks.SOURCE_COUNT_LABELS)


def test_reconciled_financial_tolerance():
    ok = checks.reconciled_financial_ok
    assert ok(*_rows(s_total="1000000.00", d_total="1000000.00")[:2])
    assert not ok(*_rows(s_total="1000000.00", d_total="950000.00")[:2])
    assert ok(*_rows(s_total="1000000.005", d_total="1000000.001")[:2])
    assert not ok(*_rows(s_total="1000000.00", d_total="1000000.01")[:2])  # bound is strict
    assert not ok(*_rows(s_total=None)[:2]) and not ok(*_rows(d_total=None)[:2])


def test_export_name_and_versions():
    assert sinks.export_name("sales_order_fact", dt.date(2025, 12, 10)) == \
        "sales_order_fact_20251210"
    a = sinks.new_version()
    time.sleep(0.002)
    b = sinks.new_version()
    assert a < b and a != b


def test_layouts_cover_the_wide_tables():
    assert set(LAYOUTS) == set(WIDE)
    for table, layout in LAYOUTS.items():
        columns = set(WIDE[table].fieldNames()) | set(layout.derived)
        assert set(layout.partition_by) | set(layout.sort_by) | set(layout.bloom) <= columns
        opts = writer_options(layout)
        assert all(f"parquet.bloom.filter.enabled#{c}" in opts for c in layout.bloom)


def test_csv_dialect_is_symmetric():
    w, r = sinks.COPY_CSV_WRITE, sinks.COPY_CSV_READ
    for key in ("quote", "escape", "timestampNTZFormat", "ignoreLeadingWhiteSpace",
                "ignoreTrailingWhiteSpace"):
        assert w[key] == r[key]
    assert w["nullValue"] == "" and w["emptyValue"] == '""'
