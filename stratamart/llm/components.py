"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is an aggregation (smallest neighbour) and a join; nothing is collected. The number of edges never grows, and the
number of rounds follows the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import staged


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def component_roots(edges: DataFrame) -> DataFrame | None:
    """From links (u, v): (u, v) with v the smallest node of u's component, for every u that is not it; None without links.

    Links to itself and nulls are left out.
    """
    edges = staged(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _mark(edges)
    if not before[0]:
        return None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        beside = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(beside.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _mark(edges)
        if now == before:
            return edges
        before = now
