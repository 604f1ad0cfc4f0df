"""Connected components by alternating stars, on DataFrames only.

Each round contracts neighbourhoods to their smallest member (a grouped minimum, so a
node with millions of links is pre-aggregated and its join side can be split). Rounds
are checkpointed; their number grows with the logarithm of the graph's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.session import materialize


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select(F.col("u"), F.col("v")).unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: (node, component), one row per node that has an edge
    to another node; ``component`` is the smallest node of the component.

    Null ends and self-loops are ignored; repeated edges do no harm; no edges give no rows.
    """
    e = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), F.col(u).alias("_a"), F.col(v).alias("_b"))
    e = e.filter("_a is not null and _b is not null and u <> v").select("u", "v").distinct()
    e = materialize(e)
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour is tied to the smallest of the neighbourhood
        both = _both_ways(e)
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        e = (both.join(low, "u").filter(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: smaller neighbours and the node itself are tied to the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = (e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v")))
             .filter("u <> v").distinct())
        e = materialize(e)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before is not None and (now["n"], now["s"]) == before:
            break
        before = (now["n"], now["s"])
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
