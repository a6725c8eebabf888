"""Lookups in priority order, latest values, first-wins unions and pivots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXCLUDE = "EXCLUDE"


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(*columns)


def value_cascade(rows: DataFrame, crosswalk: DataFrame, keys: list[str], out: str = "label") -> DataFrame:
    """Label of the first key, in order, with one: that of its value, else of the key's wildcard *.

    crosswalk(key, value, label), with line, its order, if values repeat: the first line counts. A value labelled EXCLUDE gives no label and
    blocks its key's wildcard, not later keys.
    """
    first = crosswalk.groupBy("key", "value").agg(F.min_by("label", "line").alias("label")) if "line" in crosswalk.columns else crosswalk.dropDuplicates(["key", "value"])
    found, df = [], rows
    for k in keys:
        own = first.where((F.col("key") == k) & (F.col("value") != "*")).select(F.col("value").alias(k), F.col("label").alias(f"_{k}"))
        wild = first.where((F.col("key") == k) & (F.col("value") == "*")).select(F.lit(True).alias(f"_on{k}"), F.col("label").alias(f"_w{k}"))
        df = df.join(own, k, "left").withColumn(f"_on{k}", F.col(k).isNotNull()).join(wild, f"_on{k}", "left")
        found.append(F.when(F.col(f"_{k}") == EXCLUDE, None).otherwise(F.coalesce(f"_{k}", f"_w{k}")))
    return df.withColumn(out, F.coalesce(*found)).select(*rows.columns, out)


def tier_lookup(rows: DataFrame, lookup: DataFrame, tiers: list[list[str]], columns: list[str], value: str, out: str = "label", tier: str = "tier") -> DataFrame:
    """Label by the first tier of columns that matches, and that tier's number from 1.

    A tier's entries are the lookup rows whose other columns are empty. Only distinct tuples are looked up, then joined back null-safe.
    """
    keyed = rows.select(*[F.coalesce(c, F.lit("")).alias(f"_{c}") for c in columns]).distinct()
    df = keyed
    for i, use in enumerate(tiers, 1):
        rest = [c for c in columns if c not in use]
        mine = lookup.where(reduce(lambda a, b: a & b, [F.col(c) != "" for c in use] + [F.col(c) == "" for c in rest]))
        mine = mine.dropDuplicates(use).select(*[F.col(c).alias(f"_{c}") for c in use], F.col(value).alias(f"_t{i}"))
        df = df.join(mine, [f"_{c}" for c in use], "left")
    found = [F.when(F.col(f"_t{i}").isNotNull(), F.struct(F.col(f"_t{i}").alias(out), F.lit(i).alias(tier))) for i in range(1, len(tiers) + 1)]
    df = df.select(*[f"_{c}" for c in columns], F.coalesce(*found).alias("_f")).select(*[f"_{c}" for c in columns], f"_f.{out}", f"_f.{tier}")
    on = reduce(lambda a, b: a & b, [F.coalesce(rows[c], F.lit("")) == df[f"_{c}"] for c in columns])
    return rows.join(df, on, "left").select(*[rows[c] for c in rows.columns], out, tier)


def latest(rows: DataFrame, keys: list[str], order: list[str], value: list[str], alive: Column | None = None) -> DataFrame:
    """Values at the last row of each key, by order; keys whose last row isn't alive go."""
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*order)).alias("_l")).select(*keys, "_l.*")
    return (last if alive is None else last.where(alive)).select(*keys, *value)


def wide(rows: DataFrame, keys: list[str], key: str, value: str, names: list[str]) -> DataFrame:
    """Key-value rows as columns; names are known, so one aggregation with no pass to find them."""
    return rows.groupBy(*keys).agg(*[F.max(F.when(F.col(key) == n, F.col(value))).alias(n) for n in names])


def first_wins(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union in which a key's rows all come from the first part that has it."""
    ranked = reduce(DataFrame.unionByName, [p.withColumn("_p", F.lit(i)) for i, p in enumerate(parts)])
    least = F.min("_p").over(Window.partitionBy(*keys))
    return ranked.withColumn("_m", least).where("_p = _m").drop("_p", "_m")


def tag_diff(before: Column, now: Column) -> Column:
    """Changes from one map of tags to the next: array of (key, value, change)."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    b, n = F.coalesce(before, none), F.coalesce(now, none)
    made = F.transform(F.filter(F.map_entries(n), lambda e: ~F.coalesce(F.try_element_at(b, e.key) == e.value, F.lit(False))), lambda e: F.struct(e.key.alias("key"), e.value.alias("value"), F.when(F.map_contains_key(b, e.key), "Changed").otherwise("Added").alias("change")))
    gone = F.transform(F.filter(F.map_entries(b), lambda e: ~F.map_contains_key(n, e.key)), lambda e: F.struct(e.key.alias("key"), F.lit(None).cast("string").alias("value"), F.lit("Deleted").alias("change")))
    return F.concat(made, gone)
