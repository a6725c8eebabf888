"""The two iterative operators. Each round is cut by checkpoint() in the folder that all executors share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.session import shared_folder


def cut(spark: SparkSession, df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the folder that all executors share."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def best_pairs(spark: SparkSession, pairs: DataFrame, left: str, right: str, order: list[Column]) -> DataFrame:
    """One-to-one pairs, as a greedy pass up the total order would take them.

    A pair that is first in the order for both its sides is taken; what shares a side with one taken goes; again until none is left. The first
    pair of all is always taken, so it ends. The order must be total: end it with both keys. A round sums up by key, with partial
    sums, and writes what is open once.
    """
    told = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    taken, open_ = [], pairs.withColumn("_order", told)
    while True:
        best = [open_.groupBy(k).agg(F.min("_order").alias(f"_best{i}")) for i, k in enumerate((left, right))]
        now = cut(spark, open_.join(best[0], left).join(best[1], right).withColumn("_taken", (F.col("_order") == F.col("_best0")) & (F.col("_order") == F.col("_best1"))).drop("_best0", "_best1"))
        won = now.where("_taken")
        if won.isEmpty():
            break
        taken.append(won.select(pairs.columns))
        open_ = now.where("NOT _taken").join(won.select(left), left, "left_anti").join(won.select(right), right, "left_anti").drop("_taken")
    return reduce(DataFrame.unionByName, taken, pairs.limit(0))


def components(spark: SparkSession, nodes: DataFrame, links: DataFrame, node: str = "id", rounds: int = 60) -> DataFrame:
    """(node, component) for every node, by large and small stars; component is its smallest node, singletons are their own."""
    edges = cut(spark, links.toDF("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = cut(spark, small)
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40)))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return nodes.select(F.col(node)).distinct().join(edges, F.col(node) == edges.u, "left").select(node, F.coalesce("v", node).alias("component"))


def merged_stars(stars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of stars (u, v), where each v that stands for others also has (v, v): (u, m), the least v of each u; and links (u, v) between the v that one u has.

    Both together have the components of stars; the links are as many as stars that meet, not as their rows. What is returned is cut once.
    """
    spark = stars.sparkSession
    of = F.sort_array("v")
    held = cut(spark, stars.toDF("u", "v").repartition("u").groupBy("u").agg(F.collect_set("v").alias("v")).select("u", of[0].alias("m"), F.when(F.size("v") > 1, of).alias("v")))
    return held.select("u", "m"), held.where("v IS NOT NULL").select(F.explode("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def star_components(spark: SparkSession, nodes: DataFrame, stars: DataFrame, node: str = "id") -> DataFrame:
    """components() of stars, see merged_stars: the rounds see only the links between them."""
    held, links = merged_stars(stars)
    found = components(spark, held.select(F.col("m").alias("_m")), links, "_m").withColumnRenamed("component", "_component")
    of = held.join(found, held.m == found._m).select("u", "_component")
    return nodes.select(node).distinct().join(of, F.col(node) == of.u, "left").select(node, F.coalesce("_component", node).alias("component"))
