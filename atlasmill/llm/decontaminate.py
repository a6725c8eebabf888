"""Benchmark decontamination: SimHash fingerprints of item-sized windows, found within a Hamming radius, verified exactly.

Words are terms (see shingles), so case and punctuation don't hide a leak. A window that is similar enough shares a shingle with its
item; so windows are made only around such shingles, one at each start, as long as an item that has one; a document shorter than the item is
one window, whole. A window's fingerprint has 64
bits, split into blocks: two fingerprints within the radius differ by at most radius // blocks bits in some block, and
the index holds for each block and value the items that near, so all within the radius are candidates. Those are verified by weighted
Jaccard over shingle counts; a shingle weighs log(1 + items / items that have it), both counted over the whole benchmark.

Defined results: null or empty texts and items match nothing; an item under five words is one shingle of all its words; repeated items and
rows give a row each; a null id stays null; other columns are ignored. Items go to the executors in blocks of at most BLOCK, one pass
over the documents a block, so what is broadcast of them is bounded; the shingles that several items have go whole, at 16 bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm.shingles import NOT_TERM, U64, chunks, combine, words
from atlasmill.llm.workspace import prepare, table

K, RADIUS, BLOCKS, BLOCK = 5, 23, 8, 4096


def shingles_of(h: np.ndarray) -> np.ndarray:
    return combine(h, min(K, len(h))) if len(h) else np.empty(0, U64)


def simhash(s: np.ndarray, w: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each run of size shingles."""
    bits = np.unpackbits(s.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64) * 2 - 1
    total = np.concatenate([np.zeros((1, 64)), np.cumsum(bits * w[:, None], axis=0)])
    return np.packbits(total[size:] - total[:-size] > 1e-9, axis=1).view(U64).ravel()


class Items:
    """A block of benchmark items with its index."""

    def __init__(self, rows: list[tuple[int, str | None]], n: int):
        self.ids, self.h = [], []
        for _, run in chunks([t for _, t in rows]):
            h, at = words(run, NOT_TERM)
            self.h += [h[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        keep = [i for i, h in enumerate(self.h) if len(h)]
        self.ids, self.h = [rows[i][0] for i in keep], [self.h[i] for i in keep]
        self.n = max(1, n)
        self.rare = float(np.log1p(self.n))
        self.size = np.array([len(h) for h in self.h], np.int64)
        self.s = [shingles_of(h) for h in self.h]
        at = np.concatenate([*self.s, np.empty(0, U64)])
        self.keys, place = np.unique(at, return_inverse=True)
        owner = np.repeat(np.arange(len(self.s)), [len(s) for s in self.s])
        order = np.argsort(place, kind="stable")
        self.owner, self.start = owner[order], np.searchsorted(place[order], np.arange(len(self.keys) + 1))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> U64(44)).astype(np.int64)] = True
        self.sizes = sorted({int(x) for x in np.minimum(self.size, K)}) if len(self.s) else []
        self.prints: np.ndarray | None = None

    def index(self, common: tuple[np.ndarray, np.ndarray]) -> Items:
        """With the weights of common shingles, fingerprints and what is near them; made once a worker."""
        if self.prints is not None:
            return self
        self.common, self.weights = common
        self.prints = np.array([simhash(s, self.weight(s), len(s))[0] for s in self.s], U64)
        parts = self.prints.view(np.uint8).reshape(-1, 8)
        apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
        self.near = np.stack([(apart[:, parts[:, b]] <= RADIUS // BLOCKS) for b in range(BLOCKS)]) if len(self.s) else None
        return self

    def weight(self, s: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.full(len(s), self.rare)
        at = np.minimum(np.searchsorted(self.common, s), len(self.common) - 1)
        return np.where(self.common[at] == s, self.weights[at], self.rare)

    def similarity(self, s: np.ndarray, item: int) -> float:
        a, ca = np.unique(s, return_counts=True)
        b, cb = np.unique(self.s[item], return_counts=True)
        keys = np.union1d(a, b)
        x, y = np.zeros(len(keys)), np.zeros(len(keys))
        x[np.searchsorted(keys, a)], y[np.searchsorted(keys, b)] = ca, cb
        w = self.weight(keys)
        return float((np.minimum(x, y) * w).sum() / (np.maximum(x, y) * w).sum())

    def search(self, h: np.ndarray, threshold: float) -> list[tuple[int, float, int]]:
        """(item, best similarity, first word of the best window) of the items that a text of these words has."""
        spans: dict[int, list[tuple[int, int]]] = {}
        by_k = {}
        for k in self.sizes:
            s = by_k[k] = combine(h, k)
            hit = np.flatnonzero(self.seen[(s >> U64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, s[hit]), len(self.keys) - 1)
            ok = self.keys[at] == s[hit]
            for p, q in zip(hit[ok].tolist(), at[ok].tolist(), strict=True):
                for size in {int(self.size[i]) for i in self.owner[self.start[q] : self.start[q + 1]] if min(K, self.size[i]) == k}:
                    spans.setdefault(size, []).append((max(0, p + k - size), max(0, min(p, len(h) - size))))
        best: dict[int, tuple[float, int]] = {}
        for whole, runs in spans.items():
            k, size = min(K, whole), min(whole, len(h))
            starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in runs]))
            starts = starts if len(starts) else np.arange(0)
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                if not len(run):
                    continue
                s = by_k[k][run[0] : run[-1] + size - k + 1]
                prints = simhash(s, self.weight(s), size - k + 1)
                parts = prints.view(np.uint8).reshape(-1, 8)
                mask = reduce(np.logical_or, (self.near[b][parts[:, b]] for b in range(BLOCKS))) & (self.size == whole)
                for i, j in np.argwhere(mask):
                    if int(prints[i] ^ self.prints[j]).bit_count() <= RADIUS:
                        sim = self.similarity(s[i : i + size - k + 1], int(j))
                        if sim >= threshold and sim > best.get(j, (0.0, 0))[0]:
                            best[j] = (sim, int(run[0] + i))
        return [(int(j), sim, at) for j, (sim, at) in sorted(best.items())]


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, run in chunks(batch.column("t").to_pylist()):
            h, at = words(run, NOT_TERM)
            each = [np.unique(shingles_of(h[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch({"s": pa.array(np.concatenate(each).view(np.int64), pa.int64())})


def common_shingles(benchmark: DataFrame, n: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several of the n items have, sorted, and their weights."""
    rows = benchmark.select(F.col(text_col).cast("string").alias("t")).mapInArrow(_item_shingles, "s long")
    told = rows.groupBy("s").agg(F.count("*").alias("n")).where("n > 1").toArrow()
    keys, has = told.column("s").to_numpy().view(U64), told.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], np.log1p(n / has[order])


def item_blocks(benchmark: DataFrame, n: int, item_col: str, text_col: str, block: int) -> Iterator[Items]:
    """The items in blocks, in the order of their ids, without an index."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).orderBy("i", "t")
    held: list = []
    for r in rows.toLocalIterator():
        held.append((r[0], r[1]))
        if len(held) == block:
            yield Items(held, n)
            held = []
    if held:
        yield Items(held, n)


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, item, similarity, first_word, n_words) for each row of docs and item that a window of it is similar to."""
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, item long, similarity double, first_word long, n_words long"

    n = benchmark.count()
    common = spark.sparkContext.broadcast(common_shingles(benchmark, n, item_text))

    def passes(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = sent.value.index(common.value)
            for batch in batches:
                out: list[tuple] = []
                ids = batch.column("id").to_pylist()
                for first, texts in chunks(batch.column("text").to_pylist()):
                    h, at = words(texts, NOT_TERM)
                    for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                        if b > a and items.ids:
                            out += [(ids[first + i], items.ids[j], sim, w, min(int(items.size[j]), int(b - a))) for j, sim, w in items.search(h[a:b], threshold)]
                cols = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)], names=["id", "item", "similarity", "first_word", "n_words"])

        return run

    found = [rows.mapInArrow(passes(spark.sparkContext.broadcast(items)), schema) for items in item_blocks(benchmark, n, item_col, item_text, block)]
    out = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
