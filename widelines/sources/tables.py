"""Schema-pinned reader for the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from widelines.schemas import RAW


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.schema(S).parquet(f"{sf_dir}/{name}.parquet")``."""
    return spark.read.schema(RAW[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
