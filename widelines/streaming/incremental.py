"""Incremental refresh of the wide tables for changed orders (EXT-02).

Changed orders are the keys whose order row was written after the last run
(``updated_at >= since``).  Line tables carry no timestamp, so a line edit
must touch its order row (or arrive through the change feed of
``streaming.change_feed``).  For those keys every wide row is recomputed
from the sources restricted by a semi join; every other row is carried over
from the current version with an anti join; orders that vanished from the
source are dropped by a key comparison.  The result equals a full rebuild.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widelines.functions.joins import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded
from widelines.functions.keysets import KeySet
from widelines.operators.fact import sales_order_fact
from widelines.operators.line_items import sales_order_line_items
from widelines.plans import publish_log
from widelines.plans.layouts import LAYOUTS, live_folders, partition_name, stored_schema, write_layout
from widelines.plans.sinks import new_version, read_current, read_folders, write_version
from widelines.session import scratch_path
from widelines.sources.model import Sources
from widelines.streaming.rollups import apply_delta, rollup_state

ROLLUPS = "sales_order_rollups"
#: The order-grained wide tables and their builders.
ORDER_TABLES = {"sales_order_fact": sales_order_fact, "sales_order_line_items": sales_order_line_items}


def changed_since(src: Sources, since: _dt.datetime) -> DataFrame:
    """Order ids whose order row changed at or after ``since``."""
    ts = F.lit(since).cast("timestamp_ntz")
    return (src.sales_order
            .where((F.col("updated_at") >= ts) | (F.col("created_at") >= ts))
            .select("order_id"))


def restrict(src: Sources, order_ids: DataFrame,
             max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> Sources:
    """The sources cut down to the given orders (catalogs untouched)."""
    return _restricted(src, KeySet(order_ids, "order_id", max_broadcast_rows))


def _restricted(src: Sources, keys: KeySet) -> Sources:
    return src.with_tables(
        sales_order=keys.semi(src.sales_order),
        sales_order_parts=keys.semi(src.sales_order_parts),
        sales_order_services=keys.semi(src.sales_order_services),
    )


def _merge(current: DataFrame, recomputed: DataFrame, src: Sources, order_ids: DataFrame,
           drop_deleted: bool, max_broadcast_rows: int) -> DataFrame:
    keys = broadcast_if_bounded(order_ids.select("order_id").distinct(), max_broadcast_rows)
    kept = current.join(keys, "order_id", "left_anti")
    if drop_deleted:
        kept = kept.join(src.sales_order.select("order_id"), "order_id", "left_semi")
    return kept.unionByName(recomputed).select(*current.columns)


def refresh_fact(src: Sources, current_fact: DataFrame, order_ids: DataFrame,
                 drop_deleted: bool = True,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    recomputed = sales_order_fact(restrict(src, order_ids, max_broadcast_rows))
    return _merge(current_fact, recomputed, src, order_ids, drop_deleted, max_broadcast_rows)


def refresh_line_items(src: Sources, current_lines: DataFrame, order_ids: DataFrame,
                       drop_deleted: bool = True,
                       max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    recomputed = sales_order_line_items(restrict(src, order_ids, max_broadcast_rows))
    return _merge(current_lines, recomputed, src, order_ids, drop_deleted, max_broadcast_rows)


def snapshot_before(src: Sources, cutoff: _dt.datetime) -> Sources:
    """The sources as they stood before ``cutoff`` (orders created earlier, their lines)."""
    ts = F.lit(cutoff).cast("timestamp_ntz")
    old = src.sales_order.where(F.col("created_at") < ts)
    return restrict(src.with_tables(sales_order=old), old.select("order_id"))


def write_rollups(fact: DataFrame, root: str) -> None:
    """Store and publish the rollup state of a fact table; later refreshes move it on."""
    write_version(rollup_state(fact), root, ROLLUPS)


def refresh_partitions(spark: SparkSession, src: Sources, root: str, order_ids: DataFrame,
                       tables: tuple[str, ...] = tuple(ORDER_TABLES),
                       max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> dict[str, list[str]]:
    """Refresh the live tables below ``root`` by rewriting only the partitions that changed orders touch.

    Touched are the partitions that hold rows of the changed orders now and
    those of their recomputed rows.  The new content of the touched partitions
    is written to a new version folder, recomputed rows first and once, then
    the rows that stay, and one record of the publish log switches all tables
    (and a rollup state, see below): it lists the folder of every partition, new ones for the touched (none for a partition that ends empty), the old ones for the
    rest.  Readers see the state before or after, never a mixture, and no file
    is overwritten.  Deleted orders must be among ``order_ids``; rows without a
    date have a partition of their own.  A live rollup state is moved on by the
    old and new rows of the changed orders, which lie in touched partitions.
    Returns the touched partitions.
    """
    store, version = publish_log.Store(spark, root), new_version()
    keys_path = scratch_path(spark, "changed-orders")
    order_ids.select("order_id").where("order_id is not null").distinct().write.parquet(keys_path)
    keys = KeySet(spark.read.parquet(keys_path), "order_id", max_broadcast_rows)
    changed, entries = {}, []
    for table in tables:
        layout, schema = LAYOUTS[table], stored_schema(table)
        parts = list(layout.partition_by)
        folders = live_folders(store, table)
        write_layout(ORDER_TABLES[table](_restricted(src, keys)), root, table, version, publish=False)
        written = publish_log.partition_folders(store, table, version, len(parts))
        held = keys.semi(read_folders(spark, root, table, list(folders.values()), schema).select("order_id", *parts)
                         ).select(partition_name(parts).alias("part"))
        touched = {r["part"] for r in held.distinct().collect()} | {f.split("/", 1)[1] for f in written}
        stay = [f for p, f in folders.items() if p in touched]
        if table == "sales_order_fact" and publish_log.latest(store, ROLLUPS) is not None:
            old = keys.semi(read_folders(spark, root, table, stay, schema))
            moved = apply_delta(read_current(spark, root, ROLLUPS), old, read_folders(spark, root, table, written, schema))
            write_version(moved, root, ROLLUPS, version, publish=False)
            entries.append(publish_log.Entry(ROLLUPS, version))
        # after the rollups, which read the recomputed rows from the folders that these rows join
        kept = keys.anti(read_folders(spark, root, table, stay, schema))
        write_layout(kept.drop(*layout.derived), root, table, version, publish=False, append=True)
        written = {f.split("/", 1)[1]: f for f in publish_log.partition_folders(store, table, version, len(parts))}
        live = {p: f for p, f in folders.items() if p not in touched} | written
        entries.append(publish_log.Entry(table, version, sorted(live.values()), schema.json()))
        changed[table] = sorted(touched)
    publish_log.append(store, entries)
    return changed
