"""Multi-column clustering: rows placed along a space-filling (Z-order) curve.

One sort order serves lookups on its first column only.  Along a Z-order curve
every chosen column keeps its rows together: each column's values are ranked
into range buckets of about equal size, and the bits of the ranks are
interleaved into one number.  Files then cover a narrow range of every column
at once, and the per-file ranges of ``plans.file_index`` let a lookup on any of
them skip most files.

All of it is built-in expressions: the bucket bounds come from one
``percentile_approx`` aggregate (a fixed number of bounds a column, whatever
the table's size), the rank is a binary search in them, the curve value a sum of
shifted bits, and the rows are placed by ``repartitionByRange`` on that value.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.functions.joins import file_bytes
from widelines.plans.file_index import build_file_index
from widelines.plans.sinks import WriteResult, publish_version, write_version

RANK_BITS = 6
STRING_BYTES = 7  # of a text's sort key, after what all values begin with
MIN_FILES = 64  # so that every column gets a few bits
FILE_BYTES = 32 << 20  # of the stored table: what one task sorts stays a few hundred MB in memory

#: Clustered tables: the wide table, its curve columns (with the number of rounds in which each gets a bit: the month
#: layout serves dates already), and the key that spreads rows of one curve value.
CURVES = {
    "sales_order_fact": ({"state": 1, "customer_id": 1, "order_date": 2}, ("order_id",)),
    "sales_order_line_items": ({"state": 1, "customer_id": 1, "order_date": 2}, ("order_id", "line_item_id")),
}
#: Columns with per-file ranges, and with per-file sketches.
CURVE_RANGES = {name: ("customer_id", "state", "city", "order_date") for name in CURVES}
CURVE_SKETCHES = {name: ("customer_id", "state", "city") for name in CURVES}


def clustered_name(table: str) -> str:
    return f"{table}_clustered"


def _text_key(column: str, skip: int) -> Column:
    """The bytes after the first ``skip`` characters as a number that keeps their order."""
    part = F.expr(f"substring(encode(substring(`{column}`, {skip + 1}), 'utf-8'), 1, {STRING_BYTES})")
    return F.conv(F.rpad(F.hex(part), 2 * STRING_BYTES, "0"), 16, 10).cast("long")


def sort_keys(df: DataFrame, columns: Iterable[str]) -> dict[str, Column]:
    """A long for each column that keeps its order (texts: by the bytes after their common beginning)."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    ends = df.agg(*(f(c).alias(f"{k}_{c}") for c in texts for k, f in (("lo", F.min), ("hi", F.max)))).first() if texts else None
    keys = {}
    for c in columns:
        kind = df.schema[c].dataType
        if c in texts:
            keys[c] = _text_key(c, len(os.path.commonprefix([ends[f"lo_{c}"] or "", ends[f"hi_{c}"] or ""])))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            keys[c] = F.unix_seconds(F.col(c).cast("timestamp"))
        else:
            keys[c] = F.col(c).cast("long")
    return keys


def rank_bounds(df: DataFrame, keys: dict[str, Column], bits: int = RANK_BITS) -> dict[str, list[int]]:
    """Per column the bounds of at most 2**bits range buckets of about equal size, in one aggregate."""
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    row = df.agg(*(F.percentile_approx(key, shares, 20_000).alias(c) for c, key in keys.items())).first()
    return {c: sorted(set(row[c] or [])) for c in keys}


def rank(key: Column, bounds: list[int], bits: int = RANK_BITS) -> Column:
    """How many bounds lie below the key, scaled to ``bits`` bits; NULL is 0.  A binary search: the comparisons written
    out make a method too long for the JVM to compile."""
    if not bounds:
        return F.lit(0).cast("long")
    n = len(bounds)
    places = F.lit([int(b) for b in bounds]).cast("array<bigint>")
    steps = F.lit([1 << k for k in reversed(range(n.bit_length()))])

    def step(below: Column, width: Column) -> Column:
        further = below + width
        return F.when((further <= n) & (key > F.try_element_at(places, further)), further).otherwise(below)

    below = F.aggregate(steps, F.lit(0), step)
    return F.coalesce(F.when(key.isNotNull(), F.floor(below * 2 ** bits / (n + 1)).cast("long")), F.lit(0).cast("long"))


def curve_value(ranks: list[Column], bits: int = RANK_BITS, every: list[int] | None = None) -> Column:
    """The ranks' bits interleaved, highest first: column k gives its next bit in every ``every[k]``-th round."""
    every = every or [1] * len(ranks)
    order = [(rank, bits - 1 - turn // n) for turn in range(bits * max(every)) for rank, n in zip(ranks, every)
             if turn % n == n - 1 and turn // n < bits]
    out = F.lit(0).cast("long")
    for place, (r, bit) in enumerate(reversed(order)):
        out = out + F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1).cast("long")), place)
    return out


def along_curve(df: DataFrame, columns: dict[str, int], spread_by: tuple[str, ...], files: int,
                bits: int = RANK_BITS) -> DataFrame:
    """``df`` in ``files`` ranges of the curve; rows of one curve value are spread by ``spread_by``."""
    keys = sort_keys(df, columns)
    bounds = rank_bounds(df, keys, bits)
    names = [f"_rank_{k}" for k in range(len(columns))]
    keyed = df.withColumns({f"{n}_key": keys[c] for n, c in zip(names, columns)})
    ranked = keyed.withColumns({n: rank(F.col(f"{n}_key"), bounds[c], bits) for n, c in zip(names, columns)})
    placed = ranked.withColumn("_curve", curve_value([F.col(n) for n in names], bits, list(columns.values()))).drop(
        *names, *(f"{n}_key" for n in names))
    return (placed.repartitionByRange(files, "_curve", *spread_by)
            .sortWithinPartitions("_curve", *columns, *spread_by).drop("_curve"))


def curve_files(df: DataFrame) -> int:
    """How many files a stored table is clustered into: as many as its bytes ask for."""
    return max(MIN_FILES, math.ceil(file_bytes(df) / FILE_BYTES))


def write_clustered(df: DataFrame, root: str, table: str, files: int | None = None, version: str | None = None,
                    publish: bool = True) -> WriteResult:
    """Store ``df`` (a stored table: it is read several times) along its curve as ``<table>_clustered``, with a
    file index.  ``files``: by default a share of the table's bytes (``curve_files``)."""
    columns, spread_by = CURVES[table]
    files = files or curve_files(df)
    name = clustered_name(table)
    done = write_version(along_curve(df, columns, spread_by, files), root, name, version=version,
                         writer_options={"compression": "zstd"}, publish=False)
    build_file_index(df.sparkSession, root, name, done.version, CURVE_RANGES[table], CURVE_SKETCHES[table])
    if publish:
        publish_version(df.sparkSession, root, name, done.version)
    return done
