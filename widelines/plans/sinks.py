"""Sinks: versioned all-or-nothing tables and COPY-compatible CSV export.

Tables live below a root folder:

* ``<root>/<table>/v=<version>/``  one complete Parquet dataset per build;
* ``<root>/_publish/<seq>.json``   the log of what is live (``plans.publish_log``).

A build writes a *new* version folder (Spark's commit protocol makes the
files visible only when the job commits) and only then appends a publish
record.  One append publishes any number of tables together, so the three
wide tables switch as one; a failed or half-finished build leaves the
previous versions live, nothing is ever overwritten in place, and a job
never writes a path it is reading.  Re-running a build gives a new version
with the same rows.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.plans import publish_log

LOG = logging.getLogger("widelines")

# CSV dialect of PostgreSQL ``COPY ... CSV HEADER``: NULL is an
# empty field, an empty string is "", quotes are doubled, blanks are kept,
# timestamps use a space.
COPY_CSV_WRITE = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "quoteAll": "false",
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
    "lineSep": "\n",
}
COPY_CSV_READ = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "nullValue": "\u0001",  # so that "" reads back as '' and only empty fields as NULL
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "mode": "FAILFAST",
}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANUP_LOCK = threading.Lock()
_CLEANUP_HELD: dict[int, list] = {}  # per session: how many are within, and the setting before the first


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Within, a finished query's shuffle files are deleted at once, not when the driver's memory is next collected:
    the next step has their disk.  For queries that are run once (writes, checks)."""
    key = id(spark._jsparkSession)
    with _CLEANUP_LOCK:
        held = _CLEANUP_HELD.setdefault(key, [0, spark.conf.get(CLEANUP, None)])
        held[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _CLEANUP_LOCK:
            held[0] -= 1
            if held[0] == 0:
                del _CLEANUP_HELD[key]
                if held[1] is None:
                    spark.conf.unset(CLEANUP)
                else:
                    spark.conf.set(CLEANUP, held[1])


def new_version() -> str:
    """Sortable, unique version label."""
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


@dataclass(frozen=True)
class WriteResult:
    table: str
    path: str
    version: str
    row_count: int


def write_version(df: DataFrame, root: str, table: str, version: str | None = None,
                  writer_options: dict[str, str] | None = None,
                  partition_by: tuple[str, ...] = (), publish: bool = True, append: bool = False) -> WriteResult:
    """SNK-01/02: write ``df`` as a new version, then point ``_current`` at it.  ``append`` adds rows to a version that
    is not published yet.

    The row count is observed during the write (``Observation``): no second
    pass over the data.
    """
    spark = df.sparkSession
    version = version or new_version()
    path = f"{root.rstrip('/')}/{table}/v={version}"
    obs = Observation(f"rows_{table}_{uuid.uuid4().hex[:6]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode("append" if append else "errorifexists").format("parquet")
    for k, v in (writer_options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with freed_shuffles(spark):
        w.save(path)
    rows = int(obs.get.get("rows", 0))
    if publish:
        publish_version(spark, root, table, version)
    return WriteResult(table, path, version, rows)


def publish_versions(spark: SparkSession, root: str, versions: dict[str, str]) -> None:
    """Make ``versions`` ({table: version}) live, all in one record of the log."""
    publish_log.append(publish_log.Store(spark, root), [publish_log.Entry(t, v) for t, v in versions.items()])


def publish_version(spark: SparkSession, root: str, table: str, version: str) -> None:
    publish_versions(spark, root, {table: version})


def _live(spark: SparkSession, root: str, table: str) -> publish_log.Entry:
    entry = publish_log.latest(publish_log.Store(spark, root), table)
    if entry is None:
        raise FileNotFoundError(f"no published version of {table} under {root}")
    return entry


def current_version(spark: SparkSession, root: str, table: str) -> str:
    """Latest published version of ``table``."""
    return _live(spark, root, table).version


def read_folders(spark: SparkSession, root: str, table: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """Partition folders (of any versions) of a table, with their partition columns; no folder is no row."""
    base = f"{root.rstrip('/')}/{table}"
    if not folders:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{f}" for f in folders))
            .select(*schema.fieldNames()))


def read_current(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
                 ) -> DataFrame:
    """The live version of a table, whether one folder or partition folders of several versions."""
    entry = _live(spark, root, table)
    if entry.folders is not None:
        found = read_folders(spark, root, table, entry.folders, T.StructType.fromJson(json.loads(entry.schema)))
        return found if schema is None else found.select(*schema.fieldNames())
    reader = spark.read.format("parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{root.rstrip('/')}/{table}/v={entry.version}")


def table_row_count(spark: SparkSession, root: str, table: str) -> int:
    """VAL-09 for a stored table: its row count, or -1 when it cannot be read."""
    try:
        return read_current(spark, root, table).count()
    except Exception:  # noqa: BLE001 - any unreadable table is reported as -1
        return -1


def export_name(table: str, run_date: _dt.date) -> str:
    """``<table>_<YYYYMMDD>`` (EXT-10)."""
    return f"{table}_{run_date.strftime('%Y%m%d')}"


def export_csv(df: DataFrame, out_dir: str, table: str, run_date: _dt.date,
               compression: str | None = None, partition_by: tuple[str, ...] = ()
               ) -> tuple[bool, str]:
    """SNK-03: COPY-compatible CSV, one folder of part files written in parallel.

    Returns ``(ok, path)``; a failure is logged and returns ``(False, "")``.
    """
    path = f"{out_dir.rstrip('/')}/{export_name(table, run_date)}.csv"
    try:
        w = df.write.mode("overwrite").options(**COPY_CSV_WRITE)
        if compression:
            w = w.option("compression", compression)
        if partition_by:
            w = w.partitionBy(*partition_by)
        with freed_shuffles(df.sparkSession):
            w.csv(path)
        return True, path
    except Exception as error:  # noqa: BLE001 - reported as a failed export
        LOG.error("export of %s to %s failed: %s", table, path, str(error)[:2000])
        return False, ""


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an export back with its schema; ``''`` and NULL stay distinct."""
    return spark.read.options(**COPY_CSV_READ).schema(schema).csv(path)
