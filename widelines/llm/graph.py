"""Connected components by alternating large-star and small-star rounds, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from widelines.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long, not null); component is the smallest node reachable.

    Every round links each node's neighbours to the smallest one (large-star: the larger neighbours; small-star: the
    smaller ones), by an aggregation and a join on the node, so a hub of any degree is summed before it is shuffled
    and the join can be split. A round's edges are written to the shared folder. Ends when a round changes nothing.
    """
    links = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
                   .distinct(), "edges")
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        links = stored(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
