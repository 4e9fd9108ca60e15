"""Lookups on the laid-out wide tables (the 17 access paths).

Each lookup is a ``where`` (or a semi join against a probe DataFrame) on a
table written by ``plans.layouts``; Catalyst turns it into partition
pruning, pushed Parquet filters (min/max and bloom filters) and column
pruning.  A probe set is broadcast only when a probe proves it small;
otherwise the semi join shuffles both sides on the key.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from widelines.functions.joins import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded


def by_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Equality / IN lookup."""
    return df.where(F.col(column).isin(values))


def by_probe(df: DataFrame, probe: DataFrame, keys: list[str] | str,
             max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Batched lookup: rows of ``df`` whose key appears in ``probe`` (left semi join)."""
    keys = [keys] if isinstance(keys, str) else keys
    # a NULL key matches nothing in the semi join: drop such probe rows early
    probe_keys = probe.select(*keys).where(
        reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return df.join(broadcast_if_bounded(probe_keys.distinct(), max_broadcast_rows), keys,
                   "left_semi")


def _month_index(col_year: str, col_month: str) -> Column:
    return F.col(col_year) * 12 + F.col(col_month)


def date_range_predicate(lo: _dt.date, hi: _dt.date, date_col: str = "order_date",
                         partitioned: bool = True) -> Column:
    """``lo <= date < hi``, plus the implied bound on the year/month partitions."""
    pred = (F.col(date_col) >= F.lit(_dt.datetime.combine(lo, _dt.time())).cast("timestamp_ntz")) & (
        F.col(date_col) < F.lit(_dt.datetime.combine(hi, _dt.time())).cast("timestamp_ntz"))
    if partitioned:
        last = hi - _dt.timedelta(days=1)
        pred = pred & _month_index("order_year", "order_month").between(
            lo.year * 12 + lo.month, last.year * 12 + last.month)
    return pred


def by_date_range(df: DataFrame, lo: _dt.date, hi: _dt.date, partitioned: bool = True
                  ) -> DataFrame:
    return df.where(date_range_predicate(lo, hi, partitioned=partitioned))


def revenue_by_type_and_day(lines: DataFrame) -> DataFrame:
    """Revenue per (line type, day): the query the (type, date) index served."""
    return lines.groupBy("line_item_type", F.to_date("order_date").alias("order_day")).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("line_total").alias("total_revenue"))
