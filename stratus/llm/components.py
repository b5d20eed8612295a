"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import discard, saved


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of every ``u``. Saved, so that a join with it can be split on a hot ``u``."""
    return saved(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge ``u, v`` (longs): the smallest node it reaches.

    Every round rewrites the edges towards the smallest nodes known, in a logarithmic
    number of rounds, until they are stars about the components' smallest nodes; each
    table of a round is written to the shared folder. Loops and repeated edges are fine.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = saved(both.where("v > u").join(least, "u")
                      .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "large")
        discard(now, least)
        least = _least(large)
        now = saved(large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(least.withColumnRenamed("m", "v")).distinct(), "small")
        discard(large, least)
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
