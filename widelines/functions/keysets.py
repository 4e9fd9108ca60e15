"""Semi and anti joins with many keys that shuffle few rows.

A set of keys that is too large to broadcast is broadcast as bitmaps: one
hashed bit a key, ``BITS_PER_KEY`` bits to set it in, in rows of 4 KB.  A row
whose bit is not set has no key in the set, and is dropped (or kept) where it
stands; only the others are shuffled to the keys, which decide.  The bitmaps
take ``MAX_BITMAPS`` rows at most: beyond that a bit stands for more keys, and
more rows are shuffled, but the result is the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.functions.joins import DEFAULT_MAX_BROADCAST_ROWS, is_bounded

BITS_PER_KEY = 16
BITMAP_BITS = 32_768  # of bitmap_construct_agg
MAX_BITMAPS = 4096  # 16 MB
HASHED_TYPES = (T.LongType, T.IntegerType, T.StringType)  # equal values have equal hashes


class KeySet:
    """The distinct keys of ``keys.column`` that are not NULL."""

    def __init__(self, keys: DataFrame, column: str, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS):
        self.column = column
        self.keys = keys.select(column).where(F.col(column).isNotNull()).distinct()
        self.kind = self.keys.schema[column].dataType
        self.bitmaps = None
        if is_bounded(self.keys, max_broadcast_rows):
            self.keys = F.broadcast(self.keys)
        elif isinstance(self.kind, HASHED_TYPES):
            many = keys.agg(F.approx_count_distinct(column)).first()[0]
            self.buckets = min(MAX_BITMAPS, math.ceil(BITS_PER_KEY * max(1, many) / BITMAP_BITS))
            self.bitmaps = (self.keys.select(self._bucket().alias("_bucket"), self._position().alias("_position"))
                            .groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bitmap")))

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(self.column), F.lit(self.buckets * BITMAP_BITS))

    def _bucket(self) -> Column:
        return F.floor(self._place() / BITMAP_BITS)

    def _position(self) -> Column:
        return self._place() % BITMAP_BITS

    def _marked(self, df: DataFrame) -> DataFrame | None:
        """``df`` with ``_maybe``: false where the row's key is surely not in the set."""
        if self.bitmaps is None or df.schema[self.column].dataType != self.kind:
            return None
        byte = F.substring("_bitmap", (F.floor(self._position() / 8) + 1).cast("int"), F.lit(1))
        bit = F.call_function("shiftright", F.conv(F.hex(byte), 16, 10).cast("long"), (self._position() % 8).cast("int"))
        return (df.withColumn("_bucket", self._bucket()).join(F.broadcast(self.bitmaps), "_bucket", "left")
                .withColumn("_maybe", F.coalesce(bit.bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(False)))
                .select(*df.columns, "_maybe"))

    def semi(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key is in the set."""
        marked = self._marked(df)
        near = df if marked is None else marked.where("_maybe")
        return near.join(self.keys, self.column, "left_semi").select(*df.columns)

    def anti(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key is not in the set, or is NULL."""
        marked = self._marked(df)
        if marked is None:
            return df.join(self.keys, self.column, "left_anti").select(*df.columns)
        near = marked.where("_maybe").join(self.keys, self.column, "left_anti")
        return marked.where(~F.col("_maybe")).select(*df.columns).unionByName(near.select(*df.columns))
