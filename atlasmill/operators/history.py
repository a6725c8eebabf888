"""Version histories: observations, ghosts, roll-forward. One shuffle by entity each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def observations(versions: DataFrame, entity: str, order: list[str], at: str) -> DataFrame:
    """The state of a tag along an entity's versions.

    versions: entity, order columns, at (timestamp), added, deleted, closed, reopened (booleans, nulls are false), value. Rows come out from
    the first added on (the gate); changed is 1 if the version adds the tag, deletes it, or closes or reopens the entity;
    tag_value is the last value set, null after a deletion or close until it is set or the entity reopens; last_at is the time of the version before
    among those that come out. A version that both sets the value and closes keeps the value; one that closes and reopens ends null.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    w = Window.partitionBy(entity).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    down, up = flag("deleted") | flag("closed"), flag("reopened")
    held = versions.withColumn("_gate", F.max(flag("added").cast("int")).over(run)).where("_gate = 1")
    held = held.withColumn("_set", F.last(F.when(flag("added"), F.col("value")), ignorenulls=True).over(run))
    event = F.when(flag("added"), F.struct(F.col("_set").alias("v"))).when(down, F.struct(F.lit(None).cast("string").alias("v"))).when(up, F.struct(F.col("_set").alias("v")))
    held = held.withColumn("_event", event)
    out = held.withColumn("_state", F.last("_event", ignorenulls=True).over(run))
    return out.select(*versions.columns, F.col("_state.v").alias("tag_value"), (flag("added") | down | up).cast("int").alias("changed"), F.lag(at).over(w).alias("last_at"))


def ghosts(versions: DataFrame, entity: str, order: list[str]) -> DataFrame:
    """Versions at which an entity ends, with its values before: first that applies of hard_delete, lifecycle_prefix_added, primary_tag_deleted, substantial_rename.

    versions: entity, order, booleans visible, prefix_added, primary_deleted, renamed, and name, lat, lon as set there (null: not set).
    Only those with a known place before come out.
    """
    w = Window.partitionBy(entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    kind = F.when(~F.coalesce("visible", F.lit(True)), "hard_delete").when(F.col("prefix_added"), "lifecycle_prefix_added").when(F.col("primary_deleted"), "primary_tag_deleted").when(F.col("renamed"), "substantial_rename")
    prior = {f"prior_{c}": F.last(c, ignorenulls=True).over(w) for c in ("name", "lat", "lon")}
    return versions.withColumns(prior | {"event_type": kind}).where("event_type IS NOT NULL AND prior_lat IS NOT NULL AND prior_lon IS NOT NULL")


def roll_forward(base: DataFrame, window: DataFrame, keys: list[str]) -> DataFrame:
    """base(keys, version, ...) and what of the window is new: versions above the last one known. A key and version twice counts once."""
    known = base.groupBy(*keys).agg(F.max("version").alias("_known"))
    fresh = window.join(known, keys, "left").where("_known IS NULL OR version > _known").select(base.columns).dropDuplicates([*keys, "version"])
    return base.unionByName(fresh)


def step_counts(rows: DataFrame, start: str, end: str, state: str) -> DataFrame:
    """(state, day, n): rows in each state on each day from start up to, without, end, by running sums of differences."""
    edge = rows.select(state, F.explode(F.array(F.struct(F.col(start).alias("day"), F.lit(1).alias("d")), F.struct(F.col(end).alias("day"), F.lit(-1).alias("d")))).alias("e")).select(state, "e.*")
    day = edge.groupBy(state, "day").agg(F.sum("d").alias("d"))
    return day.select(state, "day", F.sum("d").over(Window.partitionBy(state).orderBy("day")).alias("n"))


def replay(base: DataFrame, window: DataFrame, key: str, seq: str) -> DataFrame:
    """New versions (key, version, at, visible, and the other columns) that a window of diffs adds to a base of known ones.

    base(key, version, ...), window(key, seq, version, at, cut, deleted, ...): a deletion is the next version after all before it, not visible, at the time of its
    diff's cut, and counts once until the element is back; versions that the base has, or an earlier diff brought, are skipped.
    """
    order = Window.partitionBy(key).orderBy(seq, "version")
    known = base.groupBy(key).agg(F.max("version").alias("_known"), F.max_by("visible", "version").alias("_live"))
    rows = window.join(known, key, "left").withColumn("_known", F.coalesce("_known", F.lit(0)))
    live = F.when(~F.col("deleted"), F.col("version"))
    before = F.greatest("_known", F.coalesce(F.max(live).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumns({"_before": before, "_was": F.coalesce(F.lag("deleted").over(order), ~F.coalesce("_live", F.lit(True)))})
    fresh = (F.col("deleted") & ~F.col("_was")) | (~F.col("deleted") & (F.col("version") > F.col("_before")))
    told = rows.where(fresh).withColumns({"version": F.when(F.col("deleted"), F.col("_before") + 1).otherwise(F.col("version")), "at": F.when(F.col("deleted"), F.col("cut")).otherwise(F.col("at")), "visible": ~F.col("deleted")})
    return told.drop("_known", "_live", "_before", "_was", "cut", "deleted", seq)
