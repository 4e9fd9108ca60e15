"""Exact money arithmetic on ``DecimalType`` columns.

Spark's decimal cast rounds HALF_UP (away from zero for negatives), the same
rule as a PostgreSQL ``::NUMERIC(p,s)`` cast, and with ANSI mode on an
overflowing cast raises instead of returning NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the original job compares two money totals against this bound.
TOLERANCE = "0.01"


def safe_unit_price(line_total: Column | str, quantity: Column | str) -> Column:
    """``line_total / NULLIF(quantity, 0)`` rounded to ``decimal(10,2)``.

    ``nullif`` turns a zero quantity into NULL, so ANSI division by zero
    never fires and the price is NULL instead.
    """
    total = F.col(line_total) if isinstance(line_total, str) else line_total
    qty = F.col(quantity) if isinstance(quantity, str) else quantity
    return (total / F.nullif(qty, F.lit(0))).cast("decimal(10,2)")


def within_tolerance(a: Column | str, b: Column | str, tolerance: str = TOLERANCE) -> Column:
    """``abs(a - b) < tolerance`` in decimals; NULL on either side is False."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    bound = F.lit(tolerance).cast("decimal(10,4)")
    return F.coalesce(F.abs(ca - cb) < bound, F.lit(False))
