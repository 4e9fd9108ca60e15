"""A lookup index: which files of a stored version may hold a key.

Built from the stored files (``_metadata.file_path``), kept beside the version
below ``<root>/_index/<table>/v=<version>``:

* ``ranges``: a row per file with its row count and each column's min and max;
* ``sketch_<column>``: per file a blocked Bloom filter of the column's values,
  as bitmaps of 4 KB built by ``bitmap_construct_agg``, about 16 bits a value.
  That aggregate sorts its input, so a value is three numbers by then: a file
  and bucket in one long, and its positions (the file's path is joined back to
  the finished bitmaps).

A lookup of at most ``MAX_PROBE_KEYS`` keys turns them into literals, filters
the index rows (no join), and reads the remaining files only, with the keys
pushed into the scan.  Larger probes touch most files anyway: they read the
whole version with a semi join, which shuffles the rows that may match
(``functions.keysets``).
"""

from __future__ import annotations

import math
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from widelines.functions.keysets import KeySet
from widelines.plans.sinks import current_version, freed_shuffles

MAX_PROBE_KEYS = 1000
BITMAP_BITS = 32_768  # of bitmap_construct_agg
BITS_PER_VALUE = 16
HASHES = 2
POSITION_BITS = 15
BUCKET_BITS = 20


def index_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/_index/{table}/v={version}"


def _places(column: str, buckets: Column) -> Column:
    """bucket << 30 | position << 15 | position: where a value's bits stand."""
    position = [F.pmod(F.xxhash64(F.col(column), F.lit(k)), F.lit(BITMAP_BITS)) for k in range(1, HASHES + 1)]
    out = F.pmod(F.xxhash64(F.col(column), F.lit(0)), buckets)
    for p in position:
        out = F.shiftleft(out, POSITION_BITS) + p
    return out


def _part(places: Column, k: int) -> Column:
    """Position k of a value's places (HASHES is the bucket)."""
    out = F.shiftright(places, POSITION_BITS * k)
    return out if k == HASHES else out.bitwiseAND(F.lit(BITMAP_BITS - 1).cast("long"))


def _bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _block(file: Column | str, bucket: Column) -> Column:
    """A file and bucket as one long.  Files whose hashes agree would share their bitmaps, which then hold the values of
    both: lookups read a file too many, never one too few."""
    place = F.lit(BUCKET_BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", F.xxhash64(file), place), place).bitwiseOR(bucket.cast("long"))


def build_file_index(spark: SparkSession, root: str, table: str, version: str, ranges: tuple[str, ...],
                     sketches: tuple[str, ...] = ()) -> str:
    """Index a stored version: one pass for the ranges, one narrow pass for each sketched column."""
    with freed_shuffles(spark):
        return _build_file_index(spark, root, table, version, ranges, sketches)


def _build_file_index(spark: SparkSession, root: str, table: str, version: str, ranges: tuple[str, ...],
                      sketches: tuple[str, ...]) -> str:
    path = f"{root.rstrip('/')}/{table}/v={version}"
    out = index_path(root, table, version)
    rows = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    # ranges of texts are found by sorting, too: rows carry a hash of their file (equal ones would share their ranges)
    files = rows.select("file").distinct().select("file", F.xxhash64("file").alias("of"))
    (rows.groupBy(F.xxhash64("file").alias("of")).agg(
        F.count(F.lit(1)).alias("rows"),
        *(f(c).alias(f"{k}_{c}") for c in ranges for k, f in (("lo", F.min), ("hi", F.max))),
        *(F.approx_count_distinct(c).alias(f"distinct_{c}") for c in sketches))
     .join(F.broadcast(files), "of").drop("of")
     .write.parquet(f"{out}/ranges"))
    stats = spark.read.parquet(f"{out}/ranges")
    most = stats.agg(*(F.coalesce(F.max(f"distinct_{c}"), F.lit(1)).alias(c) for c in sketches)).first() if sketches else None
    for c in sketches:
        buckets = min(1 << BUCKET_BITS, max(1, math.ceil(BITS_PER_VALUE * most[c] / BITMAP_BITS)))
        placed = rows.where(F.col(c).isNotNull()).select("file", _places(c, F.lit(buckets)).alias("at"))
        bits = placed.select(_block("file", _part(F.col("at"), HASHES)).alias("block"),
                             *(_part(F.col("at"), k).alias(f"position_{k}") for k in range(HASHES)))
        each = bits.groupBy("block").agg(*(F.bitmap_construct_agg(f"position_{k}").alias(f"bitmap_{k}") for k in range(HASHES)))
        blocks = (each.select("block", F.explode(F.array(*(f"bitmap_{k}" for k in range(HASHES)))).alias("bitmap"))
                  .groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap")))
        files = stats.select("file", _block("file", F.lit(0)).alias("of"))  # a row per file
        bucket = F.col("block").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1).cast("long"))
        (blocks.withColumn("of", F.col("block") - bucket).join(F.broadcast(files), "of")
         .select("file", bucket.cast("int").alias("bucket"), "bitmap", F.lit(buckets).alias("buckets"))
         .write.parquet(f"{out}/sketch_{c}"))
    return out


def probe_keys(probe: DataFrame, column: str, limit: int = MAX_PROBE_KEYS) -> list | None:
    """The probe's distinct keys, or None when there are more than ``limit``."""
    found = probe.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    return None if len(found) > limit else [r[0] for r in found]


def candidate_files(spark: SparkSession, root: str, table: str, version: str, column: str, keys: list) -> list[str]:
    """Files of the version that may hold one of the keys: by its range, and by its sketch where there is one."""
    path = index_path(root, table, version)
    ranges = spark.read.parquet(f"{path}/ranges")
    kind = ranges.schema[f"lo_{column}"].dataType if f"lo_{column}" in ranges.columns else None
    files = ranges.select("file")
    if kind is not None:
        wanted = F.array(*(F.lit(k).cast(kind) for k in sorted(keys)))
        files = ranges.where(F.exists(wanted, lambda v: v.between(F.col(f"lo_{column}"), F.col(f"hi_{column}")))).select("file")
    if f"distinct_{column}" in ranges.columns:
        sketch = spark.read.parquet(f"{path}/sketch_{column}")
        buckets = sketch.select("buckets").first()
        if buckets is None:
            return []
        values = spark.createDataFrame([(k,) for k in keys], [column]) if keys else None
        if values is None:
            return []
        if kind is not None:
            values = values.select(F.col(column).cast(kind).alias(column))
        places = [r[0] for r in values.select(_places(column, F.lit(buckets[0]))).collect()]
        hit = F.exists(F.lit(places), lambda at: (_part(at, HASHES) == F.col("bucket"))
                       & _bit(F.col("bitmap"), _part(at, 0)) & _bit(F.col("bitmap"), _part(at, 1)))
        files = files.join(sketch.where(hit).select("file").distinct(), "file", "left_semi")
    return sorted(unquote(r["file"]) for r in files.collect())


def read_files(spark: SparkSession, root: str, table: str, version: str, files: list[str]) -> DataFrame:
    path = f"{root.rstrip('/')}/{table}/v={version}"
    whole = spark.read.parquet(path)
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).option("basePath", path).parquet(*files)


def lookup_values(spark: SparkSession, root: str, table: str, values: dict[str, list]) -> DataFrame:
    """Rows of the live version that match a few values in every given column, reading the files that may hold all."""
    version = current_version(spark, root, table)
    files = [set(candidate_files(spark, root, table, version, c, v)) for c, v in values.items()]
    found = read_files(spark, root, table, version, sorted(set.intersection(*files)))
    for c, v in values.items():
        found = found.where(F.col(c).isin(v))
    return found


def lookup(spark: SparkSession, root: str, table: str, column: str, probe: DataFrame | list,
           version: str | None = None) -> DataFrame:
    """Rows of the live (or given) version whose ``column`` is among the keys, reading candidate files only."""
    version = version or current_version(spark, root, table)
    keys = sorted(set(k for k in probe if k is not None)) if isinstance(probe, list) else probe_keys(probe, column)
    if keys is None or len(keys) > MAX_PROBE_KEYS:
        whole = spark.read.parquet(f"{root.rstrip('/')}/{table}/v={version}")
        wanted = spark.createDataFrame([(k,) for k in keys], [column]) if keys is not None else probe.select(column)
        return KeySet(wanted, column).semi(whole)
    files = candidate_files(spark, root, table, version, column, keys)
    return read_files(spark, root, table, version, files).where(F.col(column).isin(keys))
