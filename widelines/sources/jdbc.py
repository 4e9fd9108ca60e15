"""Parallel reads of the seven sources from the operational database.

Each large table is split into ``num_partitions`` ranges of its integer key
(``partitionColumn``/``lowerBound``/``upperBound``), so every executor reads
its own slice and no single connection carries the whole table.  Small
catalogs are read in one slice.  ``MONEY`` is cast to ``NUMERIC`` inside the
pushed-down query because Spark has no money type.

Not exercised by the tests: it needs a running database, and this project
starts none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widelines.schemas import SOURCES
from widelines.sources.model import Sources

# Tables split on a key; the others are small catalogs read in one slice.
_PARTITION_KEYS = {
    "sales_order": "order_id",
    "sales_order_parts": "order_id",
    "sales_order_services": "order_id",
    "customers": "customer_id",
}

_QUERIES = {
    "service": "(SELECT serviceid, service, category, labor_minutes, "
               "labor_cost::NUMERIC(19,2) AS labor_cost FROM service) AS s",
}


@dataclass(frozen=True)
class JdbcOptions:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetch_size: int = 10_000


def _reader(spark: SparkSession, opts: JdbcOptions):
    r = spark.read.format("jdbc").option("url", opts.url).option("fetchsize", opts.fetch_size)
    r = r.option("preferTimestampNTZ", "true")
    for key, value in (("user", opts.user), ("password", opts.password), ("driver", opts.driver)):
        if value is not None:
            r = r.option(key, value)
    return r


def key_bounds(spark: SparkSession, opts: JdbcOptions, table: str, key: str) -> tuple[int, int]:
    """``min``/``max`` of the split key, computed by the database."""
    row = (_reader(spark, opts)
           .option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}")
           .load().first())
    lo, hi = (row["lo"] or 0), (row["hi"] or 0)
    return int(lo), int(hi)


def read_table_jdbc(spark: SparkSession, opts: JdbcOptions, table: str,
                    num_partitions: int) -> DataFrame:
    key = _PARTITION_KEYS.get(table)
    reader = _reader(spark, opts).option("dbtable", _QUERIES.get(table, table))
    if key is None:
        return reader.load()
    lo, hi = key_bounds(spark, opts, table, key)
    return (reader.option("partitionColumn", key).option("lowerBound", lo)
            .option("upperBound", hi + 1).option("numPartitions", num_partitions).load())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the pinned columns by name, cast to the pinned types (for example a
    database ``integer`` key to ``bigint``); a missing column fails here, early."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_sources_jdbc(spark: SparkSession, opts: JdbcOptions, num_partitions: int = 64) -> Sources:
    return Sources(**{name: conform(read_table_jdbc(spark, opts, name, num_partitions), schema)
                      for name, schema in SOURCES.items()})
