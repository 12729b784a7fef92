"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpoint, parts_for, release


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Every node hands its larger (large) or smaller (small) neighbours on to the least node it knows.

    The least neighbour is an aggregate and meets the links in a join, so a node with very many links is never one group.
    """
    if large:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        met = both.join(least, "u").withColumn("least", F.least("u", "least")).where("v > u")
        return met.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
    least = links.groupBy("u").agg(F.min("v").alias("least"))  # links point from the larger to the smaller node
    met = links.join(least, "u")
    onward = met.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return onward.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """`node`, `component` (least node of it) for every node with a link; `links` has u and v of any ordered type.

    Repeated links and links of a node to itself do no harm.  Rounds grow with the logarithm of the number of nodes.
    """
    now = checkpoint(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    parts = parts_for(2 * now.count())  # a round never has more rows
    now, before = now.coalesce(parts), None
    while True:
        now = checkpoint(_stars(checkpoint(_stars(now, True).coalesce(parts)), False).coalesce(parts))
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
        release(links.sparkSession)
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
