"""Connected components of a link table by alternating star contraction, each round cut by a reliable checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import cut, hot_keys, released, spread_join


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, root`` (root: least node of the component) for every node of the links ``a, b``.

    A node's neighbours are never gathered: their minimum is aggregated before the shuffle and joined back, and the links of a
    hub with a large part of all links are dealt over several tasks (``spread_join``).
    """
    edges = cut(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    total, seen = edges.count(), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hubs = hot_keys(both.groupBy("u").agg(F.count("*").alias("n")), "u", 2 * total)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = spread_join(both, least, "u", hubs).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, lower, "u", hubs).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.select("u", F.col("m").alias("v")))
        edges = cut(spark, small.where("u <> v").distinct())
        with released(spark):
            state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        total, seen = state["n"], state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
