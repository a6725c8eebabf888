"""Aggregates over cells and orders: statistics for models, bins, estimates, running sums that no single task computes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.operators.loops import cut


def running_sum(spark: SparkSession, rows: DataFrame, order: list[str], value: Column, out: str) -> DataFrame:
    """rows with the sum of value up to each, in a total order. Ranges of the order are summed by a task each, and only their totals meet."""
    part = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    dealt = cut(spark, rows.withColumn("_value", value).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = dealt.groupBy("_part").agg(F.sum("_value").alias("_total"))
    before = totals.select("_part", (F.sum("_total").over(Window.orderBy("_part")) - F.col("_total")).alias("_before"))  # a row for each partition
    return dealt.join(before, "_part").withColumn(out, F.col("_before") + F.sum("_value").over(part)).drop("_value", "_part", "_before")


def dense_ids(spark: SparkSession, rows: DataFrame, order: list[str], out: str = "id") -> DataFrame:
    """rows numbered from 0 in a total order."""
    return running_sum(spark, rows, order, F.lit(1), out).withColumn(out, F.col(out) - 1)


def places(spark: SparkSession, rows: DataFrame, group: list[str], order: list[str], out: str, value: Column | None = None) -> DataFrame:
    """rows with the running sum of value, or their number, within their group; a group of any size is spread."""
    total = running_sum(spark, rows, [*group, *order], F.lit(1) if value is None else value, out)
    first = total.withColumn("_own", F.lit(1) if value is None else value).groupBy(*group).agg(F.min(F.col(out) - F.col("_own")).alias("_start"))
    return total.join(first, group).withColumn(out, F.col(out) - F.col("_start")).drop("_start")


def quantiles(spark: SparkSession, rows: DataFrame, group: list[str], value: str, qs: list[float], out: str = "q") -> DataFrame:
    """(group, out): exact quantiles, linear between the rows around them, by running counts of values rather than one task a group."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    run = places(spark, counts, group, [value], "_upto", F.col("_n"))
    total = run.groupBy(*group).agg(F.sum("_n").alias("_all"))
    at = lambda q: F.lit(q) * (F.col("_all") - 1)
    ends = [F.min(F.when(F.col("_upto") > f(at(q)), F.col(value))).alias(f"_{k}{i}") for i, q in enumerate(qs) for k, f in (("lo", F.floor), ("hi", F.ceil))]
    told = run.join(total, group).groupBy(*group, "_all").agg(*ends)
    return told.select(*group, F.array(*[F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (at(q) - F.floor(at(q))) for i, q in enumerate(qs)]).alias(out))


def budget(spark: SparkSession, rows: DataFrame, key: str, target: int) -> DataFrame:
    """Rows of keys drawn in the order of a hash while all their rows together are at most target; the first key always."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).withColumn("_h", F.md5(F.col(key).cast("string")))
    drawn = running_sum(spark, sizes, ["_h", key], F.col("_n"), "_rows")
    first = sizes.agg(F.min_by(key, F.struct("_h", key)).alias(key))
    return rows.join(drawn.where(F.col("_rows") <= target).select(key).unionByName(first).distinct(), key, "left_semi")


def sufficient_stats(rows: DataFrame, cell: list[str], dt: str, first: str, changed: str) -> tuple[DataFrame, DataFrame]:
    """Of unchanged rows, by cell, the sums of time of first and of later ones and how many are first; and the changed rows."""
    still = rows.where(~F.col(changed))
    stats = still.groupBy(*cell).agg(F.sum(F.when(F.col(first), F.col(dt)).otherwise(0.0)).alias("dt_first"), F.sum(F.when(F.col(first), 0.0).otherwise(F.col(dt))).alias("dt_later"), F.count_if(F.col(first)).alias("n_first"))
    return stats, rows.where(F.col(changed))


def active_cells(rows: DataFrame, cell: list[str], key: str, least: int = 100) -> DataFrame:
    """Cells of at least so many distinct keys, with their number."""
    return rows.groupBy(*cell).agg(F.count_distinct(key).alias("n")).where(F.col("n") >= least)


def quantile(counts: list[tuple[float, int]], q: float) -> float:
    """Linear between the two rows around it. counts: (value, rows), by value."""
    at = q * (sum(n for _, n in counts) - 1)
    low, high, seen = None, None, 0
    for v, n in counts:
        seen += n
        low = v if low is None and seen > int(at) else low
        high = v if high is None and seen > int(at + 1 - 1e-12) else high
    low, high = (counts[-1][0] if x is None else x for x in (low, high))
    return low + (high - low) * (at - int(at))


def atom_bins(counts: list[tuple[float, int]], bins: int, share: float = 0.05, step: float = 1e-6) -> list[tuple[float, bool]]:
    """(left edge, whether it is an atom's) of bins: a value with such a share of the rows has its own, the others meet at equal masses."""
    total = sum(n for _, n in counts)
    atoms = {v for v, n in counts if n >= share * total}
    rest = [(v, n) for v, n in counts if v not in atoms]
    edges = {counts[0][0]: False} | ({quantile(rest, i / bins): False for i in range(bins)} if rest else {})
    for a in atoms:
        edges[a + step] = edges.get(a + step, False)
    edges |= dict.fromkeys(atoms, True)
    top = max(v for v, _ in counts)
    return sorted((e, atom) for e, atom in edges.items() if e <= top)


def merge_thin(edges: list[tuple[float, bool]], counts: list[int], least: int) -> list[tuple[float, int]]:
    """(left edge, rows) once the thinnest bin has least rows: it goes into its neighbour with fewer rows, an atom's only if there is no other."""
    held = [[e, atom, n] for (e, atom), n in zip(edges, counts, strict=True)]
    if sum(counts) < least:
        return [(e, n) for e, _, n in held]
    while len(held) > 1 and min(x[2] for x in held) < least:
        i = min(range(len(held)), key=lambda k: held[k][2])
        near = [k for k in (i - 1, i + 1) if 0 <= k < len(held)]
        j = min([k for k in near if not held[k][1]] or near, key=lambda k: held[k][2])
        a, b = sorted((i, j))
        held[a:b + 1] = [[held[a][0], False, held[a][2] + held[b][2]]]
    return [(e, n) for e, _, n in held]


def binned(rows: DataFrame, value: str, bins: int, least: int, decimals: int = 6) -> DataFrame:
    """(edge, n): merged bins of a score, as of its values rounded to decimals. Only counts of distinct values reach the driver; decimals bound how many."""
    v = F.round(F.col(value).cast("double"), decimals)
    counts = [(r["v"], r["n"]) for r in rows.select(v.alias("v")).where("v IS NOT NULL AND NOT isnan(v)").groupBy("v").agg(F.count("*").alias("n")).orderBy("v").collect()]
    edges = atom_bins(counts, bins, step=10.0**-decimals) if counts else []
    sizes = [sum(n for x, n in counts if e <= x and (i + 1 == len(edges) or x < edges[i + 1][0])) for i, (e, _) in enumerate(edges)]
    return rows.sparkSession.createDataFrame([(float(e), int(n)) for e, n in merge_thin(edges, sizes, least)], "edge double, n long")


def difference_estimate(rows: DataFrame, cell: list[str], model: str, truth: str, weight: str) -> DataFrame:
    """By cell: the model's mean, plus the weighted residuals of the rows whose truth is known, a row; from 0 to 1."""
    seen = F.when(F.col(truth).isNotNull() & (F.col(weight) > 0), F.col(weight) * (F.col(truth) - F.col(model)))
    raw = F.avg(model) + F.coalesce(F.sum(seen), F.lit(0.0)) / F.count("*")
    return rows.groupBy(*cell).agg(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)).alias("estimate"), F.count("*").alias("n"), F.count(truth).alias("n_seen"))


def lin_similarity(paths: DataFrame, counts: DataFrame) -> DataFrame:
    """(a, b, lin) of leaves: twice the information of their deepest common prefix over the sum of theirs, the best over their paths.

    paths(leaf, path array, root first); counts(leaf, n). Information is -log of the share of counts under a node. Taxonomies are small; pairs meet on common prefixes.
    """
    total = counts.agg(F.sum("n").alias("total"))
    nodes = paths.join(counts, "leaf").select("leaf", "path", "n", F.explode(F.sequence(F.lit(1), F.size("path"))).alias("depth")).withColumn("node", F.array_join(F.slice("path", 1, F.col("depth")), "\x1f"))
    share = nodes.select("node", "depth", "leaf", "n").distinct().groupBy("node", "depth").agg(F.sum("n").alias("n")).join(total).select("node", "depth", (-F.log(F.col("n") / F.col("total"))).alias("ic"))
    own = nodes.where(F.col("depth") == F.size("path")).join(share, ["node", "depth"]).select("leaf", F.array_join("path", "\x1f").alias("whole"), F.col("ic").alias("own"))
    at = nodes.join(share, ["node", "depth"]).select("leaf", F.array_join("path", "\x1f").alias("whole"), "node", "ic").join(own, ["leaf", "whole"])
    both = at.select(F.col("leaf").alias("a"), "node", F.col("own").alias("oa"), "ic").join(at.select(F.col("leaf").alias("b"), "node", F.col("own").alias("ob")), "node").where("a < b")
    return both.groupBy("a", "b").agg(F.max(F.when(F.col("oa") + F.col("ob") > 0, 2 * F.col("ic") / (F.col("oa") + F.col("ob"))).otherwise(0.0)).alias("lin"))


def carried(rows: DataFrame, key: str, order: list[str], touched: Column, value: str, current: str, last: str) -> DataFrame:
    """The value of the last touch so far, and that before this row's; a touch that sets null counts."""
    w = Window.partitionBy(key).orderBy(*order)
    held = F.when(touched, F.struct(F.col(value).alias("v")))
    return rows.withColumns({current: F.last(held, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).v, last: F.last(held, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).v})


def newest(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """rows with whether each is of its keys' greatest version."""
    return rows.withColumn("newest", F.col(version) == F.max(version).over(Window.partitionBy(*keys)))


def all_labels(rows: DataFrame, crosswalk: DataFrame, keys: list[str], out: str = "labels") -> DataFrame:
    """All labels of the keys' values, once each, in the order of keys; only without one that of the wildcard that comes first in the crosswalk.

    crosswalk(key, value, label, line); of a value twice the first line counts. EXCLUDE gives no label and blocks its key's wildcard.
    """
    first = crosswalk.groupBy("key", "value").agg(F.min_by("label", "line").alias("label"), F.min("line").alias("line"))
    df, own, wild = rows, [], []
    for k in keys:
        mine = first.where((F.col("key") == k) & (F.col("value") != "*")).select(F.col("value").alias(k), F.col("label").alias(f"_{k}"))
        star = first.where((F.col("key") == k) & (F.col("value") == "*")).select(F.lit(True).alias(f"_on{k}"), F.struct("line", "label").alias(f"_w{k}"))
        df = df.join(mine, k, "left").withColumn(f"_on{k}", F.col(k).isNotNull()).join(star, f"_on{k}", "left")
        own.append(F.when(F.col(f"_{k}") != "EXCLUDE", F.col(f"_{k}")))
        wild.append(F.when(F.col(f"_{k}").isNull(), F.col(f"_w{k}")))
    found = F.array_distinct(F.array_compact(F.array(*own)))
    star = F.array_min(F.array_compact(F.array(*wild)))
    return df.select(*[rows[c] for c in rows.columns], F.when(F.size(found) > 0, found).when(star.isNotNull(), F.array(star.label)).otherwise(F.array().cast("array<string>")).alias(out))


def last_known(elements: DataFrame, snapshot: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Each element with its place in the snapshot, else that of its last change that has one. Both: key, lon, lat; changes also version."""
    at = changes.where("lon IS NOT NULL AND lat IS NOT NULL").groupBy(*key).agg(F.max_by(F.struct("lon", "lat"), "version").alias("_c"))
    df = elements.join(snapshot.select(*key, F.struct("lon", "lat").alias("_s")), key, "left").join(at, key, "left")
    place = F.coalesce(F.when(F.col("_s.lon").isNotNull(), F.col("_s")), F.col("_c"))
    return df.select(*elements.columns, place.lon.alias("lon"), place.lat.alias("lat"))


def text_key(x: Column) -> Column:
    """A key as text; a whole number read as a decimal loses its .0."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def weighted(predictions: DataFrame, weights: DataFrame, keys: list[str], weight: str = "w") -> DataFrame:
    """Predictions with the weight of their cell, 0 without one. Keys meet as text."""
    w = weights.select(*[text_key(F.col(k)).alias(f"_{k}") for k in keys], weight)
    on = reduce(lambda a, b: a & b, [text_key(predictions[k]) == w[f"_{k}"] for k in keys])
    return predictions.join(w, on, "left").select(*[predictions[c] for c in predictions.columns], F.coalesce(w[weight], F.lit(0.0)).alias(weight))
