"""Geometry as Columns: well-known binary, places inside polygons, extents, Hilbert order; and affinities and display levels."""

from __future__ import annotations

import hashlib
import math
import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmill.functions.numeric import EARTH_M, expit, logit

PLACE = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])


def kind_of(wkb: Column) -> Column:
    """Number of the type in little-endian well-known binary: bytes 2 to 5, of which the first tells the plain ones."""
    return F.conv(F.hex(F.substring(wkb, 2, 1)), 16, 10).cast("int")


def rank(wkb: Column) -> Column:
    """How much a geometry tells: point 1, line 2, polygon 3, polygons 4; others as a point."""
    k = kind_of(wkb)
    return F.when(k == 2, 2).when(k == 3, 3).when(k == 6, 4).otherwise(1)


def pick_geometry(a: Column, b: Column) -> Column:
    """b where it ranks strictly higher or a is null, else a."""
    return F.when(a.isNull() | F.coalesce(rank(b) > rank(a), F.lit(False)) & b.isNotNull(), F.coalesce(b, a)).otherwise(a)


def rings_of(wkb: bytes) -> list[list[tuple[float, float]]]:
    """Points of a point or a line as one ring, rings of a polygon or several."""
    at = 0

    def take(fmt: str):
        nonlocal at
        out = struct.unpack_from(("<" if order else ">") + fmt, wkb, at)
        at += struct.calcsize("<" + fmt)
        return out

    def points(n: int):
        flat = take(f"{2 * n}d")
        return list(zip(flat[::2], flat[1::2], strict=True))

    order = wkb[0]
    at = 1
    (kind,) = take("I")
    if kind == 1:
        return [points(1)]
    (n,) = take("I")
    if kind == 2:
        return [points(n)]
    out = []
    for _ in range(n):
        if kind == 3:
            out.append(points(take("I")[0]))
        else:
            order = wkb[at]
            at += 5
            out += [points(take("I")[0]) for _ in range(take("I")[0])]
    return out


def centre(rings: list[list[tuple[float, float]]], kind: int) -> tuple[float, float]:
    """Planar centroid: of points their mean, of lines by length, of polygons by area, holes taken off."""
    total = x = y = 0.0
    for ring in rings:
        if kind in (3, 6):
            parts = [((a[0] * b[1] - b[0] * a[1]) / 2, (a[0] + b[0]) / 3, (a[1] + b[1]) / 3) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
            area = sum(p[0] for p in parts)
            hole = any(ring is not other and _within(ring[0], other) for other in rings)
            sign = (-1 if hole else 1) * (1 if area >= 0 else -1)
            parts = [(sign * w, u, v) for w, u, v in parts]
        else:
            parts = [(math.dist(a, b), (a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(ring, ring[1:], strict=False)]
        total += sum(p[0] for p in parts)
        x += sum(p[0] * p[1] for p in parts)
        y += sum(p[0] * p[2] for p in parts)
    if total:
        return x / total, y / total
    flat = [p for r in rings for p in r]
    return sum(p[0] for p in flat) / len(flat), sum(p[1] for p in flat) / len(flat)


def _within(p: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    inside = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y0 > p[1]) != (y1 > p[1]) and p[0] < x0 + (p[1] - y0) * (x1 - x0) / (y1 - y0):
            inside = not inside
    return inside


def inner_point(rings: list[list[tuple[float, float]]]) -> tuple[float, float]:
    """The middle of the widest stretch inside, on the line half-way up the box between two heights of corners."""
    ys = sorted({y for r in rings for _, y in r})
    mid = (ys[0] + ys[-1]) / 2
    above, below = min((y for y in ys if y > mid), default=ys[-1]), max(y for y in ys if y <= mid)
    y = (above + below) / 2
    cuts = sorted(x0 + (y - y0) * (x1 - x0) / (y1 - y0) for r in rings for (x0, y0), (x1, y1) in zip(r, r[1:] + r[:1], strict=True) if (y0 > y) != (y1 > y))
    spans = [(b - a, (a + b) / 2) for a, b in zip(cuts[::2], cuts[1::2], strict=False)]
    return (max(spans)[1], y) if spans else rings[0][0]


def _places(x: pd.Series, of) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if v is None else of(bytes(v)) for v in x], columns=["lon", "lat"], dtype="float64")


@F.pandas_udf(PLACE)
def centroid(wkb: pd.Series) -> pd.DataFrame:
    """Planar centroid of well-known binary."""
    return _places(wkb, lambda b: centre(rings_of(b), b[1] if b[0] else b[4]))


@F.pandas_udf(PLACE)
def representative(wkb: pd.Series) -> pd.DataFrame:
    """A place inside a polygon; the first of points and lines."""
    return _places(wkb, lambda b: inner_point(rings_of(b)) if (b[1] if b[0] else b[4]) in (3, 6) else rings_of(b)[0][0])


def halo(x0: Column, y0: Column, x1: Column, y1: Column, buffer_m: float) -> tuple[Column, Column, Column, Column]:
    """Width and height of a box in metres, and a buffer in degrees of longitude and latitude there."""
    degree = EARTH_M * math.pi / 180
    shrink = F.greatest(F.cos(F.radians((y0 + y1) / 2)), F.lit(0.01))
    return (x1 - x0) * degree * shrink, (y1 - y0) * degree, F.lit(buffer_m / degree) / shrink, F.lit(buffer_m / degree)


def hilbert(lon: Column, lat: Column, order: int = 16) -> Column:
    """Place along the Hilbert curve of 2**order cells a side over the whole map."""
    side = 1 << order
    x = F.least(F.greatest(F.floor((lon + 180) / 360 * side), F.lit(0)), F.lit(side - 1)).cast("long")
    y = F.least(F.greatest(F.floor((lat + 90) / 180 * side), F.lit(0)), F.lit(side - 1)).cast("long")
    state = F.struct(x.alias("x"), y.alias("y"), F.lit(0).cast("long").alias("d"))

    def turn(s: Column, s_: Column) -> Column:
        rx, ry = (s.x.bitwiseAND(s_) > 0).cast("long"), (s.y.bitwiseAND(s_) > 0).cast("long")
        d = s.d + s_ * s_ * ((3 * rx).bitwiseXOR(ry))
        fx, fy = (F.when((ry == 0) & (rx == 1), side - 1 - v).otherwise(v) for v in (s.x, s.y))
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    bits = F.transform(F.sequence(F.lit(order - 1), F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    return F.aggregate(bits, state, turn, lambda s: s.d)


def first_of(x: Column) -> Column:
    """The first element; null for a null or empty list and for an empty text."""
    return F.nullif(F.get(x, F.lit(0)), F.lit(""))


def pooled(a: Column, b: Column, p: tuple[float, float, float]) -> Column:
    return expit(p[0] + p[1] * logit(a) + p[2] * logit(b))


def interacting(a: Column, b: Column, p: tuple[float, float, float, float]) -> Column:
    """As pooled, with a product of both logits."""
    x, y = logit(a), logit(b)
    return expit(p[0] + p[1] * x + p[2] * y + p[3] * x * y)


def shrunk_affinity(n: Column, seen: Column, prior: Column, k: float = 100.0) -> Column:
    """What was seen n times, shrunk to the prior and never below it, to four places; null where nothing is left."""
    v = F.round(F.greatest((n * seen + k * prior) / (n + k), prior), 4)
    return F.when(v > 0, v)


def level(x: Column, steps: int = 20) -> Column:
    """0 to steps, halves up."""
    return F.round(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) * steps).cast("int")


def ramp(x: Column, stops: list[tuple[int, int, int]]) -> Column:
    """Colour between equally spaced stops, as #rrggbb."""
    n = len(stops) - 1
    at = F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) * n
    i = F.least(F.floor(at), F.lit(n - 1)).cast("int")
    table = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in stops])
    mix = [F.round(F.get(F.get(table, i), F.lit(c)) * (1 - (at - i)) + F.get(F.get(table, i + 1), F.lit(c)) * (at - i)).cast("int") for c in range(3)]
    return F.concat(F.lit("#"), *[F.lower(F.lpad(F.hex(v), 2, "0")) for v in mix])


#: Fixed value: metres a pixel of web maps at zoom 0.
METRES_A_PIXEL = 156543.03


def zoom(metres: Column) -> Column:
    """Zoom at which a pixel is so many metres."""
    return F.log2(F.lit(METRES_A_PIXEL) / metres)


def bits_of(columns: list[tuple[str, int]]) -> Column:
    """OR of the bits of the columns that are not null or empty."""
    out = F.lit(0).cast("long")
    for c, bit in columns:
        out = out.bitwiseOR(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.lit(1 << bit)).otherwise(0).cast("long"))
    return out


@F.pandas_udf(T.DecimalType(20, 0))
def stable_seed(term: pd.Series, name: pd.Series) -> pd.Series:
    """Eight bytes of BLAKE2b of two texts, as an unsigned number."""
    from decimal import Decimal

    return pd.Series([Decimal(int.from_bytes(hashlib.blake2b(f"{a}\x1f{b}".encode(), digest_size=8).digest(), "big")) for a, b in zip(term, name, strict=True)])


def bare_url(x: Column) -> Column:
    return F.regexp_replace(x, r"^https?://(www\.)?|/$", "")


def ages(t1: Column, t2: Column, last: Column) -> tuple[Column, Column]:
    """Years of 365 days from the origin, the last tag's time or else t1, to t1 and to t2."""
    origin = F.coalesce(last, t1)
    years = lambda t: (F.unix_micros(t) - F.unix_micros(origin)) / (365 * 86_400_000_000.0)
    return years(t1), years(t2)
