"""Physical layouts that replace the 17 b-tree indexes.

An index is storage-engine machinery; what it buys is a fast answer to a
query shape.  On Parquet the same shapes are served by where the rows sit:

* partition folders (``partitionBy``) for low-cardinality filters that are
  almost always present: line type, order year and month;
* a range shuffle plus ``sortWithinPartitions`` on the lookup key, so each
  file and row group covers a narrow key range and its min/max statistics
  let the scan skip everything else (order_id, serviceid/sku);
* Parquet bloom filters for equality lookups on high-cardinality text that
  is not the sort key (invoice_number, item_code, sku).

Layouts are applied when the table is written: there is no separate
"create index" pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.functions.text import pack_columns, unpack_columns
from widelines.plans import publish_log
from widelines.plans.sinks import WriteResult, read_current, write_version
from widelines.schemas import WIDE

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a NULL
ROW_GROUP_BYTES = str(32 * 1024 * 1024)  # smaller row groups: finer min/max pruning


@dataclass(frozen=True)
class Layout:
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    derived: dict = field(default_factory=dict)  # name -> SQL expression
    placed_by: tuple[str, ...] = ()  # partition columns whose rows meet in a task; all, if none are named
    digits: tuple[str, ...] = ()  # texts that are shuffled as packed digits (functions.text)


DATE_PARTS = {"order_year": "year(order_date)", "order_month": "month(order_date)"}

LAYOUTS = {
    "sales_order_fact": Layout(
        partition_by=("order_year", "order_month"),
        sort_by=("order_id",),
        bloom=("invoice_number",),
        derived=DATE_PARTS,
    ),
    "sales_order_line_items": Layout(
        partition_by=("line_item_type", "order_year", "order_month"),
        sort_by=("order_id",),
        bloom=("item_code",),
        derived=DATE_PARTS,
        placed_by=tuple(DATE_PARTS),  # an order's part and service lines stay side by side: they share their order's columns
        digits=("line_item_id",),
    ),
    "service_parts_catalog": Layout(
        sort_by=("serviceid", "sku"),
        bloom=("sku",),
    ),
}


#: Columns of the lookup index (``plans.file_index``): ranges of all, sketches of those a file holds without order.
INDEX_RANGES = {"sales_order_fact": ("order_id", "invoice_number"),
                "sales_order_line_items": ("order_id", "item_code"),
                "service_parts_catalog": ("serviceid", "sku")}
INDEX_SKETCHES = {"sales_order_fact": ("order_id", "invoice_number"),
                  "sales_order_line_items": ("order_id", "item_code"),
                  "service_parts_catalog": ("sku",)}


def arrange(df: DataFrame, layout: Layout) -> DataFrame:
    """Add derived partition columns, place rows, sort each task's rows.

    Partitioned tables use a REBALANCE on the partition columns: rows of one
    partition folder meet in one task (few, large files), and AQE splits a
    folder that is larger than the advisory size (a month holding a third of
    all orders is written by many tasks) and merges small ones.  ``placed_by``
    names fewer columns where rows of several folders compress well together:
    a task then writes a file for each of these folders.  Tables
    without partition columns that must be stored in key order use a range
    shuffle on the sort key (a sample of the keys sets the bounds).
    """
    for name, expr in layout.derived.items():
        df = df.withColumn(name, F.expr(expr))
    if layout.partition_by:
        columns = df.columns
        df = unpack_columns(pack_columns(df, layout.digits).hint("rebalance", *(layout.placed_by or layout.partition_by)),
                            layout.digits).select(*columns)
    elif layout.sort_by:
        df = df.repartitionByRange(*layout.sort_by)
    keys = [*layout.partition_by, *layout.sort_by]
    return df.sortWithinPartitions(*keys) if keys else df


def writer_options(layout: Layout) -> dict[str, str]:
    opts = {"parquet.block.size": ROW_GROUP_BYTES, "compression": "zstd",
            "parquet.bloom.filter.adaptive.enabled": "true"}  # sized by the values, not 1 MB in every file
    for col in layout.bloom:
        opts[f"parquet.bloom.filter.enabled#{col}"] = "true"
    return opts


def stored_schema(table: str) -> T.StructType:
    """The columns of a stored table: the wide columns, then those its layout adds."""
    return T.StructType([*WIDE[table].fields, *(T.StructField(n, T.IntegerType()) for n in LAYOUTS[table].derived)])


def with_parts(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` with the layout's derived partition columns."""
    return df.withColumns({name: F.expr(expr) for name, expr in layout.derived.items()})


def partition_name(parts: list[str]) -> Column:
    """A row's partition as its folder is named (the parts hold numbers and plain words)."""
    return F.concat_ws("/", *(F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit(NO_VALUE))) for p in parts))


def live_folders(store: publish_log.Store, table: str) -> dict[str, str]:
    """Live partition -> its folder below ``<root>/<table>``."""
    entry = publish_log.latest(store, table)
    if entry is None:
        raise FileNotFoundError(f"no published version of {table} under {store.root}")
    folders = entry.folders
    if folders is None:
        folders = publish_log.partition_folders(store, table, entry.version, len(LAYOUTS[table].partition_by))
    return {f.split("/", 1)[1]: f for f in folders}


def write_layout(df: DataFrame, root: str, table: str, version: str | None = None,
                 publish: bool = True, append: bool = False) -> WriteResult:
    layout = LAYOUTS[table]
    return write_version(arrange(df, layout), root, table, version=version,
                         writer_options=writer_options(layout),
                         partition_by=layout.partition_by, publish=publish, append=append)


def read_layout(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Live version with its partition columns (needed for pruning)."""
    return read_current(spark, root, table, stored_schema(table) if table in LAYOUTS else None)


def write_bucketed(df: DataFrame, table_name: str, path: str, key: str, num_buckets: int,
                   mode: str = "errorifexists") -> DataFrame:
    """Store ``df`` as a catalog table bucketed and sorted by ``key``.

    Two tables bucketed on the same key with the same bucket count join and
    aggregate on that key without any shuffle: Spark reads bucket *i* of both
    in the same task.  The rows are hash-partitioned into ``num_buckets``
    tasks first (the same hash as bucketing), so each bucket is one file.
    The data lives at ``path``; the catalog keeps the bucketing metadata.

    Trade-off: bucketed reads have no shuffle for AQE to split, so a key
    holding a third of the rows is one task's work.  Use for keys that are
    unique or evenly spread (order_id on orders).
    """
    (df.repartition(num_buckets, key)
     .write.mode(mode).format("parquet")
     .bucketBy(num_buckets, key).sortBy(key)
     .option("path", path)
     .saveAsTable(table_name))
    return df.sparkSession.table(table_name)
