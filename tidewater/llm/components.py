"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per vertex (combined map-side) and a join back on the
vertex, whose hot side Spark splits, so a hub with any number of links is never
gathered in one task. Each round is written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch, written


def _with_least(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("m", "u"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    near = _with_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    links = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
    return links.where("u <> v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v) links of longs -> (vertex, label), label being the least vertex
    that can be reached. Only vertices with a link to another one appear."""
    spark = links.sparkSession
    path = scratch(spark, "components")
    edges = written(links.select("u", "v").where("u <> v").distinct(), f"{path}/links")
    seen, step = None, 0
    while True:
        edges = written(_small_star(_large_star(edges)), f"{path}/round{step}")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen, step = state, step + 1
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("label")).distinct()
    )
