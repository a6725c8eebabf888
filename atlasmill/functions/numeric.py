"""Numbers, dates and geometry, as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"  # the geohash alphabet, a fixed value


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def expit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def logit(p: Column) -> Column:
    q = clip(p, 1e-4, 1 - 1e-4)
    return F.log(q / (1 - q))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres on the sphere."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def geohash(lon: Column, lat: Column, precision: int = 6) -> Column:
    """Bits of longitude and latitude in turn, longitude first, five to a character."""
    bits = 5 * precision
    nx, ny = (bits + 1) // 2, bits // 2
    x = F.least(F.floor((lon + 180) / 360 * (1 << nx)), F.lit((1 << nx) - 1)).cast("long")
    y = F.least(F.floor((lat + 90) / 180 * (1 << ny)), F.lit((1 << ny) - 1)).cast("long")
    out = []
    for c in range(precision):
        digit = F.lit(0).cast("long")
        for b in range(5 * c, 5 * c + 5):
            source, place = (x, nx - 1 - b // 2) if b % 2 == 0 else (y, ny - 1 - b // 2)
            digit = digit * 2 + F.shiftright(source, place).bitwiseAND(1)
        out.append(F.substring(F.lit(BASE32), (digit + 1).cast("int"), F.lit(1)))
    return F.concat(*out)


def days(t1: Column, t2: Column) -> Column:
    """Whole days elapsed, floored; not calendar days."""
    return F.floor((F.unix_micros(t2.cast("timestamp")) - F.unix_micros(t1.cast("timestamp"))) / 86_400_000_000)


def years_tenths(t1: Column, t2: Column) -> Column:
    """Elapsed years in tenths, 0 to 100, half to even."""
    years = (F.unix_micros(t2.cast("timestamp")) - F.unix_micros(t1.cast("timestamp"))) / (365.25 * 86_400_000_000.0)
    return clip(F.bround(years * 10), 0, 100).cast("int")


def blend(a: Column, b: Column, ca: Column, cb: Column) -> Column:
    """The value of the more confident side (a wins ties), the other's where that is null or empty."""
    na, nb = F.nullif(a, F.lit("")), F.nullif(b, F.lit(""))
    return F.when(ca >= cb, F.coalesce(na, nb, a)).otherwise(F.coalesce(nb, na, b))


def blend_confidence(a: Column, b: Column, w: float = 0.7) -> Column:
    return (a + w * b) / (1 + w)


def interpolate(x: Column, xs: list[float], ys: list[float]) -> Column:
    """Piecewise linear through the nodes, flat beyond them."""
    out = F.when(x <= xs[0], F.lit(ys[0]))
    for x0, y0, x1, y1 in zip(xs, ys, xs[1:], ys[1:], strict=False):
        out = out.when(x <= x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return out.when(x.isNotNull(), F.lit(ys[-1]))


def step(x: Column, edges: list[float], values: list[float]) -> Column:
    """values[i] on [edges[i], edges[i + 1]), the last one closed."""
    return reduce(lambda acc, ev: acc.when(x < ev[0], F.lit(ev[1])), zip(edges[2:-1], values[1:-1], strict=True), F.when(x < edges[1], F.lit(values[0]))).when(x.isNotNull(), F.lit(values[-1]))


def hazard(kind: str, age: Column, p: dict[str, float]) -> Column:
    """Cumulative hazard at an age in years."""
    match kind:
        case "constant":
            return p["rate"] * age
        case "breakpoint":
            return p["rate1"] * F.least(age, F.lit(p["at"])) + p["rate2"] * F.greatest(age - p["at"], F.lit(0.0))
        case "weibull":
            return F.pow(age / p["scale"], F.lit(p["shape"]))
        case "lomax":
            return p["shape"] * F.log1p(age / p["scale"])
    raise ValueError(f"unknown hazard {kind!r}")


def changed_between(kind: str, a0: Column, a1: Column, p: dict[str, float], never: float = 0.0) -> Column:
    """Chance of a change between two ages; never: share that was wrong from the first."""
    return 1 - (1 - never) * F.exp(-(hazard(kind, a1, p) - hazard(kind, a0, p)))
