"""Broadcast only behind a proven size bound.

``is_bounded`` collects ``limit(n + 1)`` of a one-column constant.  A
collected limit runs incrementally (one partition first, then 4x more each
round, until ``n + 1`` rows are found), so for a large table the probe
usually reads part of a single partition, and never more than ``n + 1``
one-byte rows reach the driver.  (``limit(n + 1).count()`` would start a
task on every partition of the input.)  A side that passes is broadcast; any
other side falls back to the shuffle join that Catalyst plans, which AQE may
still turn into a broadcast at run time from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row bound for a broadcast dimension (about 20 MB at 100 B a row).
DEFAULT_MAX_BROADCAST_ROWS = 200_000


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows."""
    probe = df.select(F.lit(True).alias("_row")).limit(max_rows + 1)
    return len(probe.collect()) <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when its row count is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


#: Files of a code table: even when Parquet packed it well, its rows fit in an executor many times over.
SMALL_FILES_BYTES = 1 << 20


def file_bytes(df: DataFrame) -> int:
    """Bytes that the optimizer knows ``df`` to take: for a frame read from files, the files' sizes. Starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small_files(df: DataFrame, *inputs: DataFrame, max_bytes: int = SMALL_FILES_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when the frames that it is made of (``df`` itself by default) take ``max_bytes`` at most.
    ``df`` must have at most one row for each row of the first input."""
    return F.broadcast(df) if sum(map(file_bytes, inputs or (df,))) <= max_bytes else df
