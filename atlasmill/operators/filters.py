"""Row filters of ingest, labelling, model preparation and viewing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.operators.spatial import polygon_join


def _any(parts: list[Column]) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(p, F.lit(False)) for p in parts], F.lit(False)), F.lit(False))


def allowed(l0: Column, l1: Column, allow: list[tuple[str, str | None]]) -> Column:
    """Whether an allow-list has (l0, None), for all of l0, or (l0, l1). A null l0 isn't allowed."""
    return _any([l0 == a if b is None else (l0 == a) & (l1 == b) for a, b in allow])


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """Closed on all sides; box: least lon and lat, greatest lon and lat."""
    return lon.between(box[0], box[2]) & lat.between(box[1], box[3])


def tag_match(tags: Column, whole: list[str], scoped: dict[str, list[str]]) -> Column:
    """Whether a map of tags has any of the whole keys, or a scoped key with one of its values."""
    return F.coalesce(F.exists(F.map_entries(tags), lambda e: e.key.isin(whole) | _any([(e.key == k) & e.value.isin(v) for k, v in scoped.items()])), F.lit(False))


def _split(exclusions: list[tuple[str, str]], keys: list[str]) -> tuple[Column, Column]:
    """Has an excluded (key, value); has a key with another value."""
    of = {k: [v for key, v in exclusions if key == k] for k in keys}
    return _any([F.col(k).isin(v) for k, v in of.items() if v]), _any([F.col(k).isNotNull() & ~F.col(k).isin(v) if v else F.col(k).isNotNull() for k, v in of.items()])


def drop_excluded(rows: DataFrame, exclusions: list[tuple[str, str]], keys: list[str]) -> DataFrame:
    """At ingest: goes if it has an excluded tag and no other of the keys."""
    has, other = _split(exclusions, keys)
    return rows.where(~has | other)


def drop_excluded_unlabelled(rows: DataFrame, exclusions: list[tuple[str, str]], keys: list[str], label: str = "label") -> DataFrame:
    """After labelling: goes if it has an excluded tag and no label."""
    return rows.where(~(_split(exclusions, keys)[0] & F.col(label).isNull()))


def drop_label(rows: DataFrame, label: str = "label", unlabelled: bool = False, value: str = "EXCLUDE") -> DataFrame:
    """Rows labelled EXCLUDE go; with unlabelled those without a label, too."""
    kept = rows.where(F.col(label).isNull() | (F.col(label) != value))
    return kept.where(F.col(label).isNotNull()) if unlabelled else kept


def drop_residential(rows: DataFrame, areas: DataFrame, key: str, keys: list[str], scoped: list[tuple[str, str]], name: str = "name", order: str = "area") -> DataFrame:
    """Without the unnamed rows whose first non-empty key has a scoped value and that are within an area. areas: `order` and rings."""
    first = F.coalesce(*[F.when(F.coalesce(F.col(k), F.lit("")) != "", F.struct(F.lit(k).alias("k"), F.col(k).alias("v"))) for k in keys])
    scope = (F.coalesce(F.col(name), F.lit("")) == "") & _any([(first.k == k) & (first.v == v) for k, v in scoped])
    hit = polygon_join(rows.where(scope).select(key, "lon", "lat"), areas, key, order, "inner").select(key)
    return rows.join(hit, key, "left_anti")


def recent(ts: Column, now: Column, years: float | None) -> Column:
    """Not older than so many years of 365.25 days, or without a time; years of None or none at all keep everything."""
    if not years or years <= 0:
        return F.lit(True)
    return ts.isNull() | (F.unix_micros(ts) >= F.unix_micros(now) - F.lit(int(years * 365.25 * 86_400_000_000)))


def require_range(rows: DataFrame, column: str, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """rows; an error if any value is null or outside [lo, hi]."""
    bad = rows.agg(F.count_if(F.col(column).isNull()).alias("null"), F.count_if(~F.col(column).between(lo, hi)).alias("out")).first()
    if bad["null"] or bad["out"]:
        raise ValueError(f"{column}: {bad['null']} null and {bad['out']} outside [{lo}, {hi}]")
    return rows


def model_rows(rows: DataFrame, key: str, group: str, years: str, values: list[str] | None = None, least: int = 1) -> DataFrame:
    """Rows of ids that have the group in some row, of the given groups, of groups of at least so many rows, and of a positive time."""
    ids = rows.where(F.col(group).isNotNull()).select(key).distinct()
    kept = rows.join(ids, key, "left_semi")
    kept = kept.where(F.col(group).isin(values)) if values is not None else kept
    large = kept.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(group)
    return kept.join(large, group, "left_semi").where(F.col(years) > 1e-6).select(rows.columns)


def shown(label: Column, labels: list[str] | None) -> Column:
    """None shows every label, an empty list none."""
    return F.lit(True) if labels is None else F.coalesce(label.isin(labels), F.lit(False)) if labels else F.lit(False)


def any_key(keys: list[str]) -> Column:
    return _any([F.col(k).isNotNull() for k in keys])


def not_hidden(category: Column, l0: Column, hidden: list[str]) -> Column:
    """Hidden only if the key, the category or else other:l0, is switched off; unknown keys are shown."""
    return ~F.coalesce(F.coalesce(category, F.concat(F.lit("other:"), l0)).isin(hidden), F.lit(False))


def demoted(now: DataFrame, before: DataFrame, key: str, audit: DataFrame | None = None) -> DataFrame:
    """Shadow-matched rows of the second source whose confidence fell, with delta; audit (key, name) adds names."""
    both = now.join(before.select(key, F.col("conf_mean").alias("conf_before")), key, "left")
    fell = both.where((F.col("source") == "overture") & F.col("shadow_matched") & (F.col("conf_mean") < F.col("conf_before"))).withColumn("delta", F.col("conf_mean") - F.col("conf_before"))
    return fell if audit is None else fell.join(audit, key, "left")
