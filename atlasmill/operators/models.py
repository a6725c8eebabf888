"""Fits and checks of rates and scores. Rows are summed up by Spark; what the driver fits is bounded by cells, draws or rounded knots."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.numeric import changed_between
from atlasmill.operators.rating import isotonic, pool


def uniform(key: Column, rep: Column) -> Column:
    """A number from 0 to 1 that a key and a repetition always have."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(":"), rep.cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def bilinear(x: Column, y: Column, xs: list[float], ys: list[float], grid: list[list[float]]) -> Column:
    """Value of a grid of nodes (grid[i][j] at xs[i], ys[j]) between them, flat beyond."""

    def place(v: Column, nodes: list[float]) -> tuple[Column, Column]:
        v = F.least(F.greatest(v, F.lit(nodes[0])), F.lit(nodes[-1]))
        left = reduce(lambda a, b: a.when(v < b[1], F.struct(F.lit(b[0]).alias("i"), ((v - nodes[b[0]]) / (nodes[b[0] + 1] - nodes[b[0]])).alias("t"))), list(enumerate(nodes[1:]))[1:], F.when(v < nodes[1], F.struct(F.lit(0).alias("i"), ((v - nodes[0]) / (nodes[1] - nodes[0])).alias("t"))))
        told = left.otherwise(F.struct(F.lit(len(nodes) - 2).alias("i"), F.lit(1.0).alias("t")))
        return told.i, told.t

    table = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in grid])
    (i, s), (j, t) = place(x, xs), place(y, ys)
    at = lambda a, b: F.get(F.get(table, i + a), j + b)
    return (at(0, 0) * (1 - t) + at(0, 1) * t) * (1 - s) + (at(1, 0) * (1 - t) + at(1, 1) * t) * s


def by_segment(segment: Column, curves: dict[str, Column], other: Column | None = None) -> Column:
    """The curve of each row's segment; null, or other, for segments without one."""
    out = reduce(lambda acc, kv: acc.when(segment == kv[0], kv[1]), list(curves.items())[1:], F.when(segment == next(iter(curves)), next(iter(curves.values()))))
    return out if other is None else out.otherwise(other)


#: Models by name: a hazard's kind, or a function of (from, to, parameters) that gives the chance of a change.
MODELS: dict[str, str | Callable[[Column, Column, dict[str, float]], Column]] = {k: k for k in ("constant", "breakpoint", "weibull", "lomax")}


def register_model(name: str, model: str | Callable[[Column, Column, dict[str, float]], Column]) -> None:
    MODELS[name] = model


def chance(name: str, a0: Column, a1: Column, p: dict[str, float], never: float = 0.0) -> Column:
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}")
    model = MODELS[name]
    return changed_between(model, a0, a1, p, never) if isinstance(model, str) else model(a0, a1, p)


def over_draws(name: str, a0: Column, a1: Column, draws: list[dict[str, float]], width: float = 0.95) -> tuple[Column, Column, Column]:
    """Mean and interval of the chance of a change over a sampler's draws."""
    values = F.sort_array(F.array(*[chance(name, a0, a1, p) for p in draws]))
    n = len(draws)

    def quantile(q: float) -> Column:
        k = q * (n - 1)
        i = int(k)
        low, high = F.get(values, F.lit(i)), F.get(values, F.lit(min(i + 1, n - 1)))
        return low + (high - low) * (k - i)

    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n
    return mean, quantile((1 - width) / 2), quantile(1 - (1 - width) / 2)


def transform_batches(rows: DataFrame, f: Callable, schema: str) -> DataFrame:
    """A user's function of pandas batches, as Arrow brings them."""
    return rows.mapInPandas(lambda batches: (f(b) for b in batches), schema)


def predictive_p(rows: DataFrame, key: str, cell: list[str], p: str, y: str, reps: int = 20) -> DataFrame:
    """One row: the dispersion seen, and the share of replicated data sets whose dispersion is as large."""
    told = rows.groupBy(*cell).agg(F.sum(p).alias("_e"), F.sum(F.col(p) * (1 - F.col(p))).alias("_v"), F.sum(y).alias("_y"), *[F.sum((uniform(F.col(key), F.lit(r)) < F.col(p)).cast("int")).alias(f"_r{r}") for r in range(reps)]).where("_v > 0")
    phi = lambda c: F.avg(F.pow(F.col(c) - F.col("_e"), 2) / F.col("_v"))
    out = told.agg(phi("_y").alias("phi"), *[phi(f"_r{r}").alias(f"_r{r}") for r in range(reps)])
    return out.select("phi", (reduce(lambda a, b: a + b, [(F.col(f"_r{r}") >= F.col("phi")).cast("int") for r in range(reps)]) / reps).alias("p"))


def cross_validated(rows: DataFrame, key: str, cell: list[str], dt: str, y: str, folds: int = 10) -> DataFrame:
    """(fold, n, brier, log_score): each fold scored by constant rates of its cells, estimated on the other folds."""
    dealt = rows.withColumn("fold", F.floor(uniform(F.col(key), F.lit("fold")) * folds).cast("int"))
    own = dealt.groupBy(*cell, "fold").agg(F.sum(y).alias("_y"), F.sum(dt).alias("_t"))
    total = own.groupBy(*cell).agg(F.sum("_y").alias("_ay"), F.sum("_t").alias("_at"))
    rates = own.join(total, cell).select(*cell, "fold", ((F.col("_ay") - F.col("_y") + 0.5) / (F.col("_at") - F.col("_t") + 1)).alias("_rate"))
    p = 1 - F.exp(-F.col("_rate") * F.col(dt))
    hit = F.when(F.col(y) == 1, p).otherwise(1 - p)
    return dealt.join(rates, [*cell, "fold"]).groupBy("fold").agg(F.count("*").alias("n"), F.avg(F.pow(p - F.col(y), 2)).alias("brier"), F.avg(F.log(F.greatest(hit, F.lit(1e-12)))).alias("log_score"))


def difference_curve(rows: DataFrame, segment: str, x: str, model: str, truth: str, weight: str, grid: list[float], bandwidth: float) -> DataFrame:
    """(segment, at, estimate): kernel means of the model plus the weighted residuals of rows whose truth is known, from 0 to 1."""
    value = F.col(model) + F.when(F.col(truth).isNotNull() & (F.col(weight) > 0), F.col(weight) * (F.col(truth) - F.col(model))).otherwise(0.0)
    knots = rows.groupBy(segment, x).agg(F.count("*").alias("_n"), F.sum(value).alias("_v"))
    at = knots.withColumn("at", F.explode(F.array(*[F.lit(float(g)) for g in grid])))
    k = F.exp(-0.5 * F.pow((F.col("at") - F.col(x)) / bandwidth, 2))
    return at.groupBy(segment, "at").agg(F.least(F.greatest(F.sum(k * F.col("_v")) / F.sum(k * F.col("_n")), F.lit(0.0)), F.lit(1.0)).alias("estimate"))


def bootstrap_bands(rows: DataFrame, key: str, group: list[str], value: str, reps: int = 40, width: float = 0.9) -> DataFrame:
    """(group, mean, lower, upper) of a mean over Poisson bootstraps. A row's weight in each is told by its key, so all are made in one pass."""
    drawn = lambda r: (lambda u: sum((u > c).cast("int") for c in (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563)))(uniform(F.col(key), F.lit(r)))
    sums = rows.groupBy(*group).agg(F.avg(value).alias("mean"), *[(F.sum(drawn(r) * F.col(value)) / F.sum(drawn(r))).alias(f"_r{r}") for r in range(reps)])
    values = F.sort_array(F.array(*[F.col(f"_r{r}") for r in range(reps)]))

    def quantile(q: float) -> Column:
        k = q * (reps - 1)
        i = int(k)
        return F.get(values, F.lit(i)) * (1 - (k - i)) + F.get(values, F.lit(min(i + 1, reps - 1))) * (k - i)

    return sums.select(*group, "mean", quantile((1 - width) / 2).alias("lower"), quantile((1 + width) / 2).alias("upper"))


def score_parts(rows: DataFrame, p: str, y: str, digits: int = 4) -> DataFrame:
    """One row: Brier score, log score, and the Brier score's parts: miscalibration, discrimination, uncertainty, against an isotonic fit."""
    told = rows.select(F.lit(0).alias("_s"), F.round(F.col(p).cast("double"), digits).alias("_x"), F.col(y).cast("double").alias("_y"), F.lit(1.0).alias("_w"))
    fit = isotonic(told, "_s", "_x", "_y", "_w", digits).select("_x", F.col("_y").alias("_fit"))
    hit = F.when(F.col("_y") == 1, F.col("_x")).otherwise(1 - F.col("_x"))
    out = told.join(fit, "_x").agg(F.avg(F.pow(F.col("_x") - F.col("_y"), 2)).alias("brier"), F.avg(F.log(F.greatest(hit, F.lit(1e-12)))).alias("log_score"), F.avg(F.pow(F.col("_fit") - F.col("_y"), 2)).alias("_c"), F.var_pop("_y").alias("uncertainty"))
    return out.select("brier", "log_score", (F.col("brier") - F.col("_c")).alias("miscalibration"), (F.col("uncertainty") - F.col("_c")).alias("discrimination"), "uncertainty")


def design_check(rows: DataFrame, p: str, y: str, weight: str, bins: int = 10) -> DataFrame:
    """(bin, n, p, y, se, z): weighted means of what a map says and of what is true, by bins of what it says, and how far they are apart."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    w = F.col(weight)
    sums = rows.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.sum(w).alias("_w"), F.sum(w * F.col(p)).alias("_p"), F.sum(w * F.col(y)).alias("_y"), F.sum(w * w).alias("_w2"), F.sum(w * w * F.col(y)).alias("_w2y"))
    mean = F.col("_y") / F.col("_w")
    # sum of w**2 (y - mean)**2 for y of 0 and 1
    var = (F.col("_w2y") * (1 - mean) * (1 - mean) + (F.col("_w2") - F.col("_w2y")) * mean * mean) / (F.col("_w") * F.col("_w"))
    told = sums.where("_w > 0").select("bin", "n", (F.col("_p") / F.col("_w")).alias("p"), mean.alias("y"), F.sqrt(var).alias("se"))
    return told.withColumn("z", F.when(F.col("se") > 0, (F.col("y") - F.col("p")) / F.col("se")))


def monotone(values: np.ndarray, weights: np.ndarray, rounds: int = 500, tolerance: float = 1e-9) -> np.ndarray:
    """The matrix nearest in weighted squares that doesn't fall along rows or columns: pooled each way in turn, with corrections (Dykstra)."""
    x, held = values.astype(float), [np.zeros_like(values, float), np.zeros_like(values, float)]
    for _ in range(rounds):
        before = x
        for k in (0, 1):
            y = x - held[k]
            lines = y if k == 0 else y.T
            w = weights if k == 0 else weights.T
            fit = np.stack([pool(a, b) for a, b in zip(lines, w, strict=True)])
            x = fit if k == 0 else fit.T
            held[k] = x - y
        if np.abs(x - before).max() < tolerance:
            break
    return x


def fit_pool(a: np.ndarray, b: np.ndarray, y: np.ndarray, w: np.ndarray, least: float = 0.001, rounds: int = 100) -> np.ndarray:
    """(b0, b1, b2) of expit(b0 + b1 a + b2 b), by weighted likelihood, b1 and b2 at least `least`: Newton steps on what is free, halved until better."""
    x = np.stack([np.ones_like(a), a, b], 1)
    beta = np.array([0.0, 0.5, 0.5])

    def loss(v):
        z = x @ v
        return float((w * (np.logaddexp(0, z) - y * z)).sum())

    for _ in range(rounds):
        q = 1 / (1 + np.exp(-x @ beta))
        grad = x.T @ (w * (q - y))
        free = ~((beta <= least) & (grad > 0) & np.array([False, True, True]))
        h = (x[:, free] * (w * q * (1 - q))[:, None]).T @ x[:, free] + 1e-9 * np.eye(int(free.sum()))
        step = np.zeros(3)
        step[free] = np.linalg.solve(h, grad[free])
        size, now = 1.0, loss(beta)
        while size > 1e-8:
            tried = beta - size * step
            tried[1:] = np.maximum(tried[1:], least)
            if loss(tried) <= now:
                break
            size /= 2
        moved = np.abs(tried - beta).max()
        beta = tried
        if moved < 1e-10:
            break
    return beta


def sample(log_density: Callable[[np.ndarray], float], start: np.ndarray, warm: int = 1000, draws: int = 1000, chains: int = 4, seed: int = 0) -> np.ndarray:
    """(chain, draw, parameter): random-walk Metropolis; while warming up, steps take the shape of the draws so far and a size that takes a third."""
    out = np.empty((chains, draws, len(start)))
    for c in range(chains):
        rng = np.random.default_rng([seed, c])
        x, size, shape = start + 0.1 * rng.standard_normal(len(start)), 2.4 / np.sqrt(len(start)), np.eye(len(start)) * 0.1
        now, seen = log_density(x), []
        for i in range(warm + draws):
            to = x + size * (shape @ rng.standard_normal(len(x)))
            new = log_density(to)
            took = np.log(rng.random()) < new - now
            if took:
                x, now = to, new
            if i < warm:
                size *= np.exp((float(took) - 0.33) / np.sqrt(i + 1))
                seen.append(x)
                if i % 100 == 99 and i >= 199:
                    shape = np.linalg.cholesky(np.cov(np.array(seen[len(seen) // 2 :]).T).reshape(len(x), len(x)) + 1e-9 * np.eye(len(x)))
            else:
                out[c, i - warm] = x
    return out


def r_hat(draws: np.ndarray) -> np.ndarray:
    """Of halves of chains, by parameter."""
    half = draws.shape[1] // 2
    x = np.concatenate([draws[:, :half], draws[:, half : 2 * half]])
    within, between = x.var(axis=1, ddof=1).mean(axis=0), half * x.mean(axis=1).var(axis=0, ddof=1)
    return np.sqrt(((half - 1) / half * within + between / half) / within)


def effective(draws: np.ndarray) -> np.ndarray:
    """Effective draws by parameter: all of them over one plus twice the autocorrelations, up to the first pair that isn't positive."""
    chains, n, k = draws.shape
    x = draws - draws.mean(axis=1, keepdims=True)
    out = []
    for p in range(k):
        f = np.fft.rfft(x[:, :, p], 2 * n)
        auto = np.fft.irfft(f * f.conj())[:, :n].mean(axis=0)
        rho = auto / auto[0]
        total = 0.0
        for t in range(1, n - 1, 2):
            if rho[t] + rho[t + 1] < 0:
                break
            total += rho[t] + rho[t + 1]
        out.append(chains * n / (1 + 2 * total))
    return np.array(out)


def fit_random_rates(stats: DataFrame, changed: DataFrame, cell: str, dt: str, digits: int = 2, **how: int) -> tuple[list, np.ndarray]:
    """Cells, and draws (chain, draw, [mean, log spread, log rate of each cell]): rates of change that vary between cells about a common mean.

    stats, changed: as sufficient_stats gives them. Times of changed rows are rounded to digits, so that cells and times bound what is gathered.
    """
    still = {r[cell]: r["t"] for r in stats.groupBy(cell).agg(F.sum(F.col("dt_first") + F.col("dt_later")).alias("t")).collect()}
    rows = changed.groupBy(F.col(cell), F.round(dt, digits).alias("_t")).agg(F.count("*").alias("_n")).collect()
    names = sorted(still.keys() | {r[cell] for r in rows})
    place = {c: i for i, c in enumerate(names)}
    at, t, n = (np.array(v, float) for v in zip(*[(place[r[cell]], max(r["_t"], 10.0**-digits), r["_n"]) for r in rows], strict=True)) if rows else (np.empty(0),) * 3
    at = at.astype(int)
    calm = np.array([still.get(c, 0.0) for c in names])

    def density(x: np.ndarray) -> float:
        mean, spread, eff = x[0], np.exp(x[1]), x[2:]
        rate = np.exp(eff)
        ll = -(rate * calm).sum() + (n * np.log(-np.expm1(-rate[at] * t) + 1e-300)).sum()
        return float(ll - 0.5 * (((eff - mean) / spread) ** 2).sum() - len(eff) * x[1] - 0.5 * (mean / 3) ** 2 - 0.5 * (x[1] / 1.0) ** 2)

    hits = np.bincount(at, weights=n, minlength=len(names)) if len(at) else np.zeros(len(names))
    spent = calm + (np.bincount(at, weights=n * t, minlength=len(names)) if len(at) else 0)
    start = np.log((hits + 0.5) / (spent + 1))
    return names, sample(density, np.concatenate([[start.mean(), -0.5], start]), **how)


def collapse_days(rows: DataFrame, key: str, order: list[str], at: str, deleted: str) -> DataFrame:
    """The last version of each key and day, as daily diffs give them; a deletion has the time of the day's end, when the diff is cut."""
    day = F.to_date(at)
    last = rows.withColumn("_day", day).groupBy(key, "_day").agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order)).alias("_r"))
    out = last.select(key, "_day", "_r.*")
    return out.withColumn(at, F.when(F.col(deleted), F.date_add("_day", 1).cast(rows.schema[at].dataType)).otherwise(F.col(at))).select(rows.columns)
