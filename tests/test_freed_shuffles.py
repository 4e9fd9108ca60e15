"""A write leaves no shuffle files behind."""

import datetime as dt
import os

from widelines.plans import sinks


def _shuffle_files(spark):
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in root for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, scratch):
    before = _shuffle_files(spark)
    df = spark.range(1000).repartition(4, "id")
    sinks.write_version(df, scratch, "t")
    assert not _shuffle_files(spark) - before
    assert sinks.export_csv(df, scratch, "t", dt.date(2025, 1, 1))[0]
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(sinks.CLEANUP, None) in (None, "false")
    df.write.format("noop").mode("overwrite").save()  # other queries are left as they are
    assert _shuffle_files(spark) - before
