"""What changes between releases: ids replayed and migrated, histories held against snapshots, ended places that live on in another source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions import fuzzy
from atlasmill.operators import conflate, spatial


def replay(release: DataFrame, registry: DataFrame) -> DataFrame:
    """release(rid, keys array) with the id the registry(source_key, unified_id, id_minted) has for any of its keys: the oldest; null if none."""
    known = release.select("rid", F.explode("keys").alias("source_key")).join(registry, "source_key")
    ids = known.groupBy("rid").agg(F.min_by("unified_id", F.struct("id_minted", "unified_id")).alias("unified_id"))
    return release.join(ids, "rid", "left")


def migration(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old_id, new_id) of ids that share a source key; both have (source_key, unified_id)."""
    return old.select("source_key", F.col("unified_id").alias("old_id")).join(new.select("source_key", F.col("unified_id").alias("new_id")), "source_key").select("old_id", "new_id").distinct()


def mismatches(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: keys on one side only, and per column how many shared keys differ (nulls are equal)."""
    both = old.select(key, F.struct(*columns).alias("a")).join(new.select(key, F.struct(*columns).alias("b")), key, "full")
    differ = [F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(c) for c in columns]
    return both.agg(F.count_if(F.col("b").isNull()).alias("only_old"), F.count_if(F.col("a").isNull()).alias("only_new"), *differ)


def history_check(history: DataFrame, snapshot: DataFrame, key: str, order: list[str], until: Column) -> DataFrame:
    """One row: of snapshot(key, edited, name) edited before `until`, how many the history(key, at, name) has, with the same last time and name."""
    last = history.groupBy(key).agg(F.max("at").alias("at"), F.max_by("name", F.struct(*order)).alias("last_name"))
    seen = snapshot.where(F.col("edited") < until).join(last.withColumn("_found", F.lit(1)), key, "left")
    return seen.agg(F.count("*").alias("n"), F.count("_found").alias("found"), F.count_if(F.col("at") == F.col("edited")).alias("same_time"), F.count_if(F.col("last_name") == F.col("name")).alias("same_name"))


def shadow_matches(spark: SparkSession, ghosts: DataFrame, others: DataFrame, radius: float = 100.0, least: float = 0.70) -> DataFrame:
    """One-to-one (ghost, other, score, distance_m): ended places that another source still lists as the same entity nearby.

    ghosts(ghost, lon, lat, name, brand, new_name, label), others(other, lon, lat, name2, brand2, label2). Both names are needed; name or brand of one side
    must be the same entity as name or brand of the other, and where the ghost was renamed, the other must not bear the new name.
    """
    near = spatial.radius_join(ghosts, others, F.lit(radius), radius).where("name IS NOT NULL AND name <> '' AND name2 IS NOT NULL AND name2 <> ''")
    pairings = [(a, b) for a in ("name", "brand") for b in ("name2", "brand2")]
    same = F.lit(False)
    for a, b in pairings:
        same = same | F.coalesce(fuzzy.same_name_udf(a, b), F.lit(False))
    renamed = F.coalesce(fuzzy.same_name_udf("new_name", "name2"), F.lit(False))
    ratios = [F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), fuzzy.set_ratio_udf(a, b).cast("double")) for a, b in pairings]
    kind = conflate.type_score(F.coalesce("label", F.lit("")), F.coalesce("label2", F.lit("")), F.lit(0), F.lit(0))
    score = conflate.composite(conflate.distance_score(F.col("distance_m"), F.lit(radius)), conflate.name_score(ratios), kind, F.lit(0.0), F.lit(False))
    scored = near.where(same & ~renamed).select("ghost", "other", "distance_m", score.alias("score"))
    return conflate.match(spark, scored, "ghost", "other", least)
