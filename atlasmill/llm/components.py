"""Connected components of a link table, by alternating large and small stars over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.llm.workspace import Workspace


def components(ws: Workspace, links: DataFrame, rounds: int = 60) -> DataFrame:
    """links(u, v), longs, in any order, repeated or not. Returns (node, root) for each node that has a link and isn't a root.

    root is the smallest node of the component. Each round is written to the shared folder; no link reaches the driver.
    Nulls and self-links are left out. A hub's links stay spread: only its minimum is aggregated by key, with partial sums.
    """
    edges = ws.save(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = ws.save(small.where("u <> v").distinct(), "star")
        seen = now.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x"), F.coalesce(F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40))), F.lit(0)).alias("y")).first()
        ws.drop(edges)
        edges = now
        if seen == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
    raise RuntimeError(f"components did not settle in {rounds} rounds")
