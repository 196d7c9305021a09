"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node in links (a, b).

    Every step hangs neighbours under the smallest one nearby; edges never grow in number, and
    a logarithmic number of steps leaves stars. Each step is a stored table; the driver only sees a count and a checksum.
    """
    edges = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.join(low, F.col("a") == F.col("u"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = store(small.filter("a != b").distinct(), "links")
