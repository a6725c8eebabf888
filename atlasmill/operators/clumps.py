"""Components of links that a score of distance, name and type gives, without a row for each link.

In a tile, rows of one class (name, label, bits, radius) that lie so close that they are linked for sure are one clump; two clumps are linked if their boxes or,
where those don't tell, their nearest rows say so. What is in one component already is not compared. So a place with many rows costs their number, not its square.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.fuzzy import set_ratio
from atlasmill.functions.numeric import EARTH_M
from atlasmill.operators.spatial import METRES_A_DEGREE

SLACK = 1e-6  # metres that bounds leave to rounding
PAIRS, NEAREST = 2_000_000, 200_000  # pairs of clumps, and of rows, at a time


def tiles(rows: DataFrame, reach: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """rows by _row and _col, with _x, lon as that tile sees it across the date line: two rows within reach metres have a tile in common."""
    w = reach * 1.000001 / METRES_A_DEGREE
    dy = 2 * w
    at = rows.withColumn("_row", F.explode(F.array_distinct(F.array(F.floor(F.col(lat) / dy), F.floor((F.col(lat) - w) / dy)))))
    cos = F.cos(F.radians(F.least(F.greatest(F.abs(F.col("_row") * dy), F.abs((F.col("_row") + 1) * dy + w)), F.lit(90.0))))
    polar, dx = cos < 0.01, dy / F.greatest(cos, F.lit(0.01))
    at = at.withColumn("_x", F.explode(F.when(~polar & (F.col(lon) > 180 - dx), F.array(lon, F.col(lon) - 360)).otherwise(F.array(lon))))
    cols = F.when(polar, F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(F.array(F.floor(F.col("_x") / dx), F.floor((F.col("_x") - dx / 2) / dx))))
    return at.withColumn("_col", F.explode(cols))


def join(r: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """r, the least member of each node's component, after links u, v."""
    r = r.copy()
    while True:
        a, b = r[u], r[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        if not len(u):
            return r
        np.minimum.at(r, np.maximum(a, b), np.minimum(a, b))
        while not (r[r] == r).all():
            r = r[r]


def _spread(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, 0 .. size[i] - 1) for every i."""
    i = np.repeat(np.arange(len(size)), size)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)


def _batches(size: np.ndarray, most: int):
    """Slices of about most in all, one item at least."""
    total, at = np.cumsum(size), 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield slice(at, to)
        at = to


class Tile:
    """Rows of a tile: places, codes of names, labels and bits (null: -1, -1, 0) and radius."""

    def __init__(self, x, lon, lat, name, label, bits, radius, names: list[str], empty: int, weights: tuple[float, float, float], search: float, least: float):
        self.x, self.lon, self.lat, self.names, self.empty, self.weights, self.search, self.least = x, lon, lat, names, empty, weights, search, least
        self.ratios: dict[tuple[int, int], float] = {}
        classes, self.of = np.unique(np.column_stack([name, label, bits, radius.view(np.int64)]), axis=0, return_inverse=True)
        self.of = self.of.ravel()
        self.name, self.label, self.bits, self.radius = classes[:, 0], classes[:, 1], classes[:, 2], np.ascontiguousarray(classes[:, 3]).view(np.float64)
        self.told = np.array([i >= 0 and names[i].strip(" ") != "" for i in self.name])
        lo, hi = np.abs(lat).min(), np.abs(lat).max()
        self.cmax = 1.0 if lat.min() <= 0 <= lat.max() else math.cos(math.radians(lo))
        self.cmin = math.cos(math.radians(min(hi, 90.0)))
        if self.cmin < 0.01:
            self.cmin = 0.0

    def fixed(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(name score, type score, radius) of pairs of classes."""
        name = np.full(len(a), 0.5)
        both = np.flatnonzero(self.told[a] & self.told[b])
        pairs, at = np.unique(np.minimum(self.name[a[both]], self.name[b[both]]) << 32 | np.maximum(self.name[a[both]], self.name[b[both]]), return_inverse=True)
        for k in pairs.tolist():
            if k not in self.ratios:
                self.ratios[k] = set_ratio(self.names[k >> 32], self.names[k & 0xFFFFFFFF]) / 100
        name[both] = np.array([self.ratios[k] for k in pairs.tolist()])[at] if len(pairs) else 0.5
        same = (self.label[a] == self.label[b]) & (self.label[a] >= 0) & (self.label[a] != self.empty)
        kind = np.where(same, 1.0, np.where(self.bits[a] & self.bits[b] != 0, 0.5, 0.0))
        return name, kind, np.maximum(self.radius[a], self.radius[b])

    def passes(self, d, name, kind, radius):
        w = self.weights
        return (d <= self.search) & (w[0] * np.maximum(0.0, np.minimum(1.0, 1 - d / radius)) + w[1] * name + w[2] * kind >= self.least)

    def limit(self, name, kind, radius):
        """The distance up to which a pair is linked, but for rounding; negative: none is."""
        need = (self.least - self.weights[1] * name - self.weights[2] * kind) / self.weights[0]
        return np.where(need <= 0, self.search, np.minimum(self.search, radius * (1 - need)))

    def metres(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        p, q = np.radians(self.lat[i]), np.radians(self.lat[j])
        a = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin((np.radians(self.lon[j]) - np.radians(self.lon[i])) / 2) ** 2
        return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(1.0, a)))

    def components(self) -> np.ndarray:
        n = len(self.lon)
        every = np.arange(len(self.name))
        name, kind, radius = self.fixed(every, every)
        own = self.limit(name, kind, radius)
        # no pair of a class reaches farther
        reach = np.minimum(self.search, self.limit(np.where(self.told, 1.0, 0.5), np.ones(len(every)), np.full(len(every), self.radius.max())))
        x, y = self.x * (METRES_A_DEGREE * self.cmax), self.lat * METRES_A_DEGREE
        r = self._same_place(np.arange(n), reach)
        rows = np.flatnonzero(reach[self.of] > 1e-9)
        if not len(rows):
            return r
        # clumps: cells whose diagonal is within the limit, or single rows
        side = (own[self.of[rows]] - SLACK) / 1.4143
        celled = side > 1e-3
        side = np.where(celled, side, 1.0)
        cell = np.column_stack([self.of[rows], np.where(celled, np.floor((x[rows] - x.min()) / side), -1 - rows), np.where(celled, np.floor((y[rows] - y.min()) / side), 0)]).astype(np.int64)
        clump = np.unique(cell, axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(clump, kind="stable")
        rows, clump = rows[order], clump[order]
        begin = np.flatnonzero(np.diff(clump, prepend=-1))
        size = np.diff(np.append(begin, len(rows)))
        r = join(r, rows, rows[begin][clump])
        box = [f.reduceat(v[rows], begin) for v in (x, y) for f in (np.minimum, np.maximum)]
        by = np.argsort(box[2], kind="stable")
        box = [v[by] for v in box]
        begin, size = begin[by], size[by]
        of, lead = self.of[rows[begin]], rows[begin]
        far = reach[of]
        doubt = []
        some = np.maximum(0, np.searchsorted(box[2], box[3] + far + 2 * SLACK, "right") - 1 - np.arange(len(by)))
        for part in _batches(some, PAIRS):
            i, k = _spread(some[part])
            i += part.start
            j = i + 1 + k
            fresh = r[lead[i]] != r[lead[j]]
            i, j = i[fresh], j[fresh]
            gap_x, gap_y = (np.maximum(0.0, np.maximum(box[c][i], box[c][j]) - np.minimum(box[c + 1][i], box[c + 1][j])) for c in (0, 2))
            low = 0.999 * np.hypot(gap_x * (self.cmin / self.cmax), gap_y)
            near = low <= np.minimum(far[i], far[j]) + SLACK
            i, j, low = i[near], j[near], low[near]
            classes, at = np.unique(of[i] << 32 | of[j], return_inverse=True)
            told = self.fixed(classes >> 32, classes & 0xFFFFFFFF)
            limit = self.limit(*told)[at]
            high = np.hypot(*(np.maximum(box[c + 1][i], box[c + 1][j]) - np.minimum(box[c][i], box[c][j]) for c in (0, 2)))
            sure = high <= limit - SLACK
            r = join(r, lead[i[sure]], lead[j[sure]])
            left = ~sure & (low <= limit + SLACK) & (r[lead[i]] != r[lead[j]])
            doubt.append((i[left], j[left], *(v[at[left]] for v in told)))
        i, j, *told = (np.concatenate(v) for v in zip(*doubt, strict=True)) if doubt else (np.empty(0, np.int64),) * 5
        while len(i):
            part = next(_batches(size[i] * size[j], NEAREST))
            a, b = i[part], j[part]
            pair, k = _spread(size[a] * size[b])
            d = self.metres(rows[begin[a][pair] + k // size[b][pair]], rows[begin[b][pair] + k % size[b][pair]])
            least = np.minimum.reduceat(d, np.cumsum(size[a] * size[b]) - size[a] * size[b])
            hit = self.passes(least, *(v[part] for v in told))
            r = join(r, lead[a[hit]], lead[b[hit]])
            i, j, *told = (v[part.stop :] for v in (i, j, *told))
            left = r[lead[i]] != r[lead[j]]
            i, j, *told = (v[left] for v in (i, j, *told))
        return r

    def _same_place(self, r: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Classes that reach nowhere else are linked with what lies at the very same place."""
        place = np.unique(np.column_stack([self.lon, self.lat]), axis=0, return_inverse=True)[1].ravel()
        key, at = np.unique(place << 32 | self.of, return_inverse=True)
        lead = np.full(len(key), len(place))
        np.minimum.at(lead, at, np.arange(len(place)))
        count = np.bincount(at)
        of, begin = key & 0xFFFFFFFF, np.flatnonzero(np.diff(key >> 32, prepend=-1))
        size = np.diff(np.append(begin, len(key)))
        group = np.repeat(np.arange(len(begin)), size)
        narrow = np.flatnonzero((reach[of] <= 1e-9) & ((size[group] > 1) | (count > 1)))
        linked = np.zeros(len(key), np.int64) - 1  # a class at the place that all of this one's rows are linked with
        for part in _batches(size[group[narrow]], PAIRS):
            i, k = _spread(size[group[narrow[part]]])
            i = narrow[part][i]
            j = begin[group[i]] + k
            use = (i != j) | (count[i] > 1)
            i, j = i[use], j[use]
            hit = self.passes(np.zeros(len(i)), *self.fixed(of[i], of[j]))
            i, j = i[hit], j[hit]
            r = join(r, lead[i], lead[j])
            linked[i], linked[j] = i, j
        rows = np.flatnonzero(linked[at] >= 0)
        return join(r, rows, lead[at[rows]])


def forest(key: str, weights: tuple[float, float, float], search: float, least: float):
    """Of a tile's rows (key, _name, _label, _bits, _radius, _x, _lon, _lat), links (u, v) to the least key of each component of several, its own among them."""

    def run(t: pa.Table) -> pa.Table:
        codes = []
        for c in ("_name", "_label"):
            d = pa.concat_arrays(t.column(c).chunks).dictionary_encode()
            codes.append((d.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()))
        (name, names), (label, labels) = codes
        bits, radius, x, lon, lat = (t.column(c).to_numpy() for c in ("_bits", "_radius", "_x", "_lon", "_lat"))
        tile = Tile(x, lon, lat, name, label, bits, radius, names, labels.index("") if "" in labels else -1, weights, search, least)
        root = tile.components()
        ids, rank = np.unique(t.column(key).to_numpy(zero_copy_only=False), return_inverse=True)
        first = np.full(len(root), len(ids))
        np.minimum.at(first, root, rank)
        linked = np.flatnonzero(np.bincount(root, minlength=len(root))[root] > 1)
        kind = t.schema.field(key).type
        return pa.table({"u": pa.array(ids[rank[linked]], kind), "v": pa.array(ids[first[root[linked]]], kind)})

    return run


def links(rows: DataFrame, key: str, name: str, label: str, bits: str, radius: str, weights: tuple[float, float, float], search: float, least: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(u, v): at most one link for each row and tile, with the same components as all pairs within search metres whose score is at least least.

    v is the least of the rows that are one component in a tile, and is linked with itself: links for loops.star_components.
    """
    r = F.col(radius).cast("double")
    told = rows.select(key, F.col(name).alias("_name"), F.col(label).alias("_label"), F.coalesce(F.col(bits).cast("long"), F.lit(0)).alias("_bits"), r.alias("_radius"), F.col(lon).cast("double").alias("_lon"), F.col(lat).cast("double").alias("_lat"))
    told = told.where(F.col(key).isNotNull() & F.col("_lon").isNotNull() & F.col("_lat").isNotNull() & ~F.isnan("_lon") & ~F.isnan("_lat") & (F.col("_radius") > 0))
    kind = rows.schema[key].dataType.simpleString()
    return tiles(told, search, "_lon", "_lat").groupBy("_row", "_col").applyInArrow(forest(key, weights, search, least), f"u {kind}, v {kind}")
