"""Rollups maintained by deltas (EXT-03 with EXT-02): no rebuild, no scan of unchanged partitions.

A stored rollup state holds, per period, the row count and for every measure
its sum and how many of its values are not NULL.  A refresh turns the changed
orders into signed rows: their old fact rows subtract, their recomputed rows
add.  Periods whose count reaches 0 vanish, and a sum without any value is
NULL again, so the state always equals the rollup of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Measure of the fact -> its name in the rollup.
MEASURES = {"total_amount": "total_revenue", "subtotal": "total_subtotal", "tax": "total_tax",
            "parts_line_count": "parts_lines", "services_line_count": "services_lines"}
SUM_TYPES = {"total_amount": "decimal(22,2)", "subtotal": "decimal(22,2)", "tax": "decimal(22,2)",
             "parts_line_count": "bigint", "services_line_count": "bigint"}
UNITS = ("day", "month")


def period(unit: str) -> Column:
    day = F.to_date("order_date")
    return day if unit == "day" else F.trunc(day, unit)


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """One state row for each fact row and unit."""
    return rows.select(F.explode(F.array(*(F.struct(F.lit(u).alias("unit"), period(u).alias("period")) for u in UNITS))).alias("_p"),
                       F.lit(sign).cast("long").alias("rows"),
                       *(F.coalesce(F.col(m), F.lit(0)).cast(SUM_TYPES[m]).alias(f"sum_{m}") if sign > 0
                         else (-F.coalesce(F.col(m), F.lit(0))).cast(SUM_TYPES[m]).alias(f"sum_{m}") for m in MEASURES),
                       *(F.when(F.col(m).isNotNull(), sign).otherwise(0).cast("long").alias(f"n_{m}") for m in MEASURES)
                       ).select("_p.*", "rows", *(f"sum_{m}" for m in MEASURES), *(f"n_{m}" for m in MEASURES))


def summed(states: DataFrame) -> DataFrame:
    """State rows of equal unit and period added up; periods without rows vanish."""
    return states.groupBy("unit", "period").agg(
        F.sum("rows").alias("rows"),
        *(F.sum(f"sum_{m}").cast(SUM_TYPES[m]).alias(f"sum_{m}") for m in MEASURES),
        *(F.sum(f"n_{m}").alias(f"n_{m}") for m in MEASURES)).where(F.col("rows") != 0)


def rollup_state(fact: DataFrame) -> DataFrame:
    """The state of a whole fact table, by day and by month."""
    return summed(signed(fact, 1))


def apply_delta(state: DataFrame, old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The state after ``old_rows`` of the fact were replaced by ``new_rows``."""
    return summed(state.unionByName(signed(old_rows, -1)).unionByName(signed(new_rows, 1)))


def rollup(state: DataFrame, unit: str) -> DataFrame:
    """The rollup of one unit in the columns of ``reports.daily_rollup`` / ``monthly_rollup``."""
    return state.where(F.col("unit") == unit).select(
        F.col("period").alias(f"order_{unit}"), F.col("rows").alias("order_count"),
        *(F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}")).alias(name) for m, name in MEASURES.items()))
