"""Rating places from fitted curves, and the statistics that say how well curves and intervals fit.

Posterior draws are a bounded parameter: they come as an array of so many draws, worked on inside a row, or as small tables of effects.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def urban_class(population: Column, density: Column) -> Column:
    """urban above 100,000 people and 1,000 a square mile, else suburban above 500 a square mile, else rural; null density is rural."""
    dense = F.coalesce(density, F.lit(0.0))
    return F.when((F.coalesce(population, F.lit(0)) > 100_000) & (dense > 1000), "urban").when(dense > 500, "suburban").otherwise("rural")


def group_lookup(rows: DataFrame, curves: DataFrame, fallback: DataFrame, group: str, at: str) -> DataFrame:
    """rows with conf_mean, conf_lower, conf_upper from their group's curve at the integer `at`; the fallback where a group has none.

    curves(group, at, mean, lower, upper), fallback(at, mean, lower, upper): chances of change, so bounds swap.
    """
    own = curves.select(group, at, *[F.col(c).alias(f"_{c}") for c in ("mean", "lower", "upper")])
    rest = fallback.select(at, *[F.col(c).alias(f"_f{c}") for c in ("mean", "lower", "upper")])
    df = rows.join(own, [group, at], "left").join(rest, at, "left")
    conf = {f"conf_{name}": 1 - F.coalesce(f"_{c}", f"_f{c}") for name, c in (("mean", "mean"), ("lower", "upper"), ("upper", "lower"))}
    return df.select(*rows.columns, *[x.alias(name) for name, x in conf.items()])


def cell_curves(rows: DataFrame, base: DataFrame, effects: dict[str, DataFrame], at: str, never: float = 0.0, width: float = 0.95) -> DataFrame:
    """rows with the posterior mean and interval of confidence 1 - p(at), from additive effects on the log rate.

    base(draw, value); effects: column -> (column, draw, value). Each distinct cell and age is worked out once. A level without effects, and null, count as 0.
    """
    keys = [*effects, at]
    draws = base.agg(F.collect_list(F.struct("draw", F.col("value").alias("_base"))).alias("_draws"))  # one row: as many as the sampler drew
    cells = rows.select(keys).distinct().join(F.broadcast(draws)).select(*keys, F.inline("_draws"))
    parts = [F.col("_base")]
    for i, (key, table) in enumerate(effects.items()):
        cells = cells.join(table.select(key, "draw", F.col("value").alias(f"_e{i}")), [key, "draw"], "left")
        parts.append(F.coalesce(f"_e{i}", F.lit(0.0)))
    rate = F.exp(reduce(lambda a, b: a + b, parts))
    conf = (1 - never) * F.exp(-rate * F.col(at))
    tail = (1 - width) / 2
    told = cells.withColumn("_c", conf).groupBy(keys).agg(F.avg("_c").alias("conf_mean"), F.percentile("_c", tail).alias("conf_lower"), F.percentile("_c", 1 - tail).alias("conf_upper"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    return rows.alias("r").join(told.alias("t"), same, "left").select("r.*", "conf_mean", "conf_lower", "conf_upper")


def zie_loglik(rate: Column, first: Column, never: Column, changed: Column) -> Column:
    """Log likelihood of one interval: rate over it, share `never` wrong from the first counted in first intervals only."""
    stay = -rate + F.when(first, F.log1p(-never)).otherwise(0.0)
    return F.when(changed, F.log(-F.expm1(stay))).otherwise(stay)


def pointwise(loglik: Column) -> tuple[Column, Column]:
    """(log mean exp, sample variance) of an array of log likelihoods over draws; null for an empty array."""
    top = F.array_max(loglik)
    n = F.size(loglik)
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    mean = total(loglik) / n
    return top + F.log(total(F.transform(loglik, lambda x: F.exp(x - top))) / n), total(F.transform(loglik, lambda x: (x - mean) * (x - mean))) / (n - 1)


def fit_scores(rows: DataFrame, loglik: Column, predicted: Column, target: Column) -> DataFrame:
    """One row: lppd, p_waic, waic, rmse, n."""
    lppd, var = pointwise(loglik)
    told = rows.select(lppd.alias("l"), var.alias("v"), F.pow(predicted - target, 2).alias("e"))
    return told.agg(F.sum("l").alias("lppd"), F.sum("v").alias("p_waic"), (-2 * (F.sum("l") - F.sum("v"))).alias("waic"), F.sqrt(F.avg("e")).alias("rmse"), F.count("*").alias("n"))


def dispersion(rows: DataFrame, cells: list[str], predicted: str, target: str) -> DataFrame:
    """One row: cells and phi, the mean over cells of (observed - expected)^2 / variance; cells of no variance are left out."""
    p = F.col(predicted)
    told = rows.groupBy(cells).agg(F.sum(target).alias("y"), F.sum(p).alias("e"), F.sum(p * (1 - p)).alias("v")).where("v > 0")
    return told.agg(F.count("*").alias("cells"), F.avg(F.pow(F.col("y") - F.col("e"), 2) / F.col("v")).alias("phi"))


def event_overlap(truth: DataFrame, found: DataFrame, keys: list[str], at: str, start: str, end: str, pad_days: int = 1) -> DataFrame:
    """One row: recall and precision of two sets of events. One of a window counts if the other set has its keys within the padded window."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    pad = F.expr(f"INTERVAL {pad_days} DAYS")
    inside = lambda df: df.where((F.col(at) >= lo) & (F.col(at) < hi))
    near = lambda df: df.where((F.col(at) >= lo - pad) & (F.col(at) < hi + pad)).select(keys).distinct().withColumn("_hit", F.lit(1.0))
    share = lambda a, b, name: inside(a).join(near(b), keys, "left").agg(F.avg(F.coalesce("_hit", F.lit(0.0))).alias(name), F.count("*").alias(f"n_{name}"))
    return share(truth, found, "recall").join(share(found, truth, "precision"))


def same_columns(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """(column, same): whether two releases hold the same values, whatever their order, by count, sum and xor of 64-bit hashes."""
    told = lambda df: df.agg(*[F.struct(F.count("*").alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64(c), F.lit(1 << 31))), F.lit(0)).alias("s"), F.coalesce(F.bit_xor(F.xxhash64(c)), F.lit(0)).alias("x")).alias(c) for c in columns])
    long = lambda df: told(df).select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("h")) for c in columns])).alias("r")).select("r.*")
    return long(a).join(long(b).withColumnRenamed("h", "h2"), "column").select("column", (F.col("h") == F.col("h2")).alias("same"))


def weighted_curves(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Weighted mean of value per keys; null where weights sum to 0."""
    w = F.sum(weight)
    return rows.groupBy(keys).agg(F.when(w != 0, F.sum(F.col(value) * F.col(weight)) / w).alias(value))


def coverage(rows: DataFrame, sim: str, truth: str, estimate: str, lower: str, upper: str) -> DataFrame:
    """One row: share covered, bias, simulations, and the share of simulations all of whose rows are covered."""
    inside = F.col(truth).between(F.col(lower), F.col(upper))
    per = rows.groupBy(sim).agg(F.count("*").alias("n"), F.sum(inside.cast("int")).alias("c"), F.sum(F.col(estimate) - F.col(truth)).alias("b"), F.bool_and(inside).alias("every"))
    return per.agg((F.sum("c") / F.sum("n")).alias("covered"), (F.sum("b") / F.sum("n")).alias("bias"), F.count("*").alias("sims"), F.avg(F.col("every").cast("int")).alias("simultaneous"))


def cell_means(rows: DataFrame, value: str, i: str, j: str, shape: tuple[int, int]) -> DataFrame:
    """(i, j, mean) of every cell of a grid, NaN where it is empty."""
    grid = rows.sparkSession.range(shape[0] * shape[1]).select(F.floor(F.col("id") / shape[1]).cast("int").alias(i), (F.col("id") % shape[1]).cast("int").alias(j))
    told = rows.groupBy(F.col(i).cast("int").alias(i), F.col(j).cast("int").alias(j)).agg(F.avg(value).alias("mean"))
    return grid.join(told, [i, j], "left").select(i, j, F.coalesce("mean", F.lit(float("nan"))).alias("mean"))


def jeffreys_rates(rows: DataFrame, keys: list[str], hit: str, weight: str) -> DataFrame:
    """Weighted share of hits per keys, with half a hit and half a miss added."""
    return rows.groupBy(keys).agg(((F.sum(F.when(F.col(hit), F.col(weight)).otherwise(0.0)) + 0.5) / (F.sum(weight) + 1.0)).alias("rate"))


def kernel_curve(rows: DataFrame, segment: str, x: str, y: str, weight: str, grid: list[float], bandwidth: float) -> DataFrame:
    """(segment, at, y): Gaussian kernel means on a grid. Rows of equal x are summed first, so each distinct x meets the grid once."""
    knots = rows.groupBy(segment, x).agg(F.sum(weight).alias("_w"), F.sum(F.col(y) * F.col(weight)).alias("_wy"))
    at = knots.withColumn("at", F.explode(F.array(*[F.lit(float(g)) for g in grid])))
    k = F.exp(-0.5 * F.pow((F.col("at") - F.col(x)) / bandwidth, 2))
    return at.groupBy(segment, "at").agg((F.sum(k * F.col("_wy")) / F.sum(k * F.col("_w"))).alias(y))


def pool(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Nearest non-decreasing values in weighted least squares: neighbours out of order are pooled."""
    mean, mass, run = [], [], []
    for v, w in zip(values, weights, strict=True):
        mean.append(v)
        mass.append(w)
        run.append(1)
        while len(mean) > 1 and mean[-2] > mean[-1]:
            w = mass[-2] + mass[-1]
            mean[-2:] = [(mean[-2] * mass[-2] + mean[-1] * mass[-1]) / w]
            mass[-2:] = [w]
            run[-2:] = [run[-2] + run[-1]]
    return np.repeat(mean, run)


def isotonic(rows: DataFrame, segment: str, x: str, y: str, weight: str, digits: int = 4) -> DataFrame:
    """(segment, x, y): non-decreasing fit per segment on knots of x. x is rounded to `digits`, which bounds the knots one task sees."""
    knots = rows.groupBy(F.col(segment), F.round(F.col(x).cast("double"), digits).alias(x)).agg(F.sum(F.col(weight).cast("double")).alias("_w"), F.sum(F.col(y).cast("double") * F.col(weight)).alias("_wy"))
    kind = rows.schema[segment].dataType.simpleString()

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat(batches).sort_values(x)
        held = held[held["_w"] > 0]
        yield pd.DataFrame({segment: held[segment], x: held[x], y: pool((held["_wy"] / held["_w"]).to_numpy(), held["_w"].to_numpy())})

    return knots.groupBy(segment).applyInPandas(lambda g: next(fit(iter([g]))), f"`{segment}` {kind}, `{x}` double, `{y}` double")


def falls(curves: DataFrame, segment: str, at: str, value: str, tolerance: float = 1e-9) -> DataFrame:
    """Points of curves that lie below the point before them by more than the tolerance; an export needs none."""
    before = F.lag(value).over(Window.partitionBy(segment).orderBy(at))
    return curves.withColumn("before", before).where(F.col(value) - F.col("before") < -tolerance)


def export_curves(curves: DataFrame, segment: str, at: str, value: str, path: str) -> None:
    """Writes curves; raises where one falls."""
    if bad := falls(curves, segment, at, value).take(1):
        raise ValueError(f"curve falls at {bad[0]}")
    curves.write.mode("overwrite").parquet(path)
