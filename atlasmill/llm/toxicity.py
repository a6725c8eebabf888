"""Toxicity by a factorization machine over hashed terms: linear weights, and pairwise ones as products of latent vectors.

A term is a run of letters, digits and non-ASCII characters, A-Z lower-cased; its presence anywhere in the whole text sets one
of 2**HASH_BITS features. The machine is fitted on at most MAX_TRAIN labelled rows, those with the smallest hash of their id, over
the SELECTED features whose presence, alone or beside another's, tells most about the label there. Scoring reads every whole text, once, with no shuffle.

Defined results: null and empty texts have no features and score the base rate; with no labelled row every score is 0; a null
id is never held out and never learnt from; a text labelled twice counts as toxic if either label says so; repeated rows are
scored each; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm.shingles import term_sets
from atlasmill.llm.workspace import prepare, table

HASH_BITS, MAX_TRAIN, SELECTED, LATENT = 20, 20_000, 4096, 8
#: Frequent features of which pairs are formed, and the chi-squared that a pair must have beyond those of its terms.
COMMON, PAIRED = 1024, 24


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    for terms in term_sets(texts):
        yield np.unique(terms >> np.uint64(64 - HASH_BITS)).astype(np.int32)


@dataclass
class Machine:
    """score(x) = sigmoid(bias + sum of w + half of (square of the sum of v - sum of the squares of v)) over the features present."""

    place: np.ndarray  # feature -> row, or -1
    bias: float
    w: np.ndarray
    v: np.ndarray

    def score(self, x: np.ndarray) -> float:
        r = self.place[x]
        r = r[r >= 0]
        v = self.v[r]
        z = self.bias + self.w[r].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def select(rows: list[np.ndarray], y: np.ndarray, n: int, least: int = 4) -> np.ndarray:
    """Up to n features of least rows or more: half for what their presence alone tells about the label, half for what it does beside another's.

    The first are those with the largest chi-squared, above 4. A pair of terms may tell what neither does alone, so of the others, those
    with the largest chi-squared of a pair are taken with their partners; pairs are formed of the COMMON most frequent features, over all rows.
    """
    count = lambda some: np.bincount(np.concatenate([np.empty(0, np.int32), *some]), minlength=1 << HASH_BITS).astype(float)
    df, hit = count(rows), count([r for r, label in zip(rows, y, strict=True) if label])
    alone = _chi(df, hit, y)
    alone[df < least] = -1
    best = np.argsort(-alone, kind="stable")[: n // 2]
    best = best[alone[best] > 4]
    # terms of nearly all rows form no pairs that differ from the partner
    often = np.argsort(-np.where((df >= least) & (df <= 0.9 * len(y)), df, -1), kind="stable")[:COMMON]
    often = np.sort(often[df[often] >= least])
    if len(often) > 1:
        both, hits = np.zeros((2, len(often), len(often)))
        for s in range(0, len(rows), 2000):
            x = np.zeros((len(rows[s : s + 2000]), len(often)), np.float32)
            for i, r in enumerate(rows[s : s + 2000]):
                place = np.searchsorted(often, r).clip(max=len(often) - 1)
                x[i, place[often[place] == r]] = 1
            both += x.T @ x
            hits += x.T @ (x * y[s : s + 2000, None].astype(np.float32))
        chi = _chi(both, hits, y)
        # what the pair tells beyond either term
        chi -= np.maximum(_chi(df[often], hit[often], y)[:, None], _chi(df[often], hit[often], y)[None, :])
        chi[both < least] = -1
        np.fill_diagonal(chi, -1)
        top = np.argsort(-chi.max(axis=1), kind="stable")[: n - n // 2]
        best = np.concatenate([best, often[top[chi.max(axis=1)[top] > PAIRED]]])
    return np.unique(best)


def _chi(df: np.ndarray, hit: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Chi-squared of presence in df rows, hit of them labelled, against the label."""
    rate = y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num((hit - df * rate) ** 2 / (df * rate * (1 - rate) * np.maximum(1 - df / len(y), 1e-9)))


def fit(rows: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.15, l2_w: float = 2e-4, l2_v: float = 2e-3, seed: int = 7) -> Machine:
    rng = np.random.default_rng(seed)
    place = np.full(1 << HASH_BITS, -1, np.int32)
    base = float(y.mean()) if len(y) else 0.0
    if not len(y) or base in (0.0, 1.0):
        return Machine(place, 40.0 if base == 1.0 else -40.0, np.zeros(1, np.float32), np.zeros((1, LATENT), np.float32))
    kept = select(rows, y, SELECTED)
    place[kept] = np.arange(len(kept))
    x = [r[r >= 0] for r in (place[r] for r in rows)]
    m = max(1, len(kept))
    w, v = np.zeros(m), rng.normal(0, 0.02, (m, LATENT))
    bias, gw, gv, gb = float(np.log(base / (1 - base))), np.full(m, 1e-3), np.full((m, LATENT), 1e-3), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(y), batch):
            pick = order[s : s + batch]
            each = np.array([len(x[i]) for i in pick])
            at, doc = np.concatenate([x[i] for i in pick]).astype(np.int64), np.repeat(np.arange(len(pick)), each)
            va = v[at]
            total = np.stack([np.bincount(doc, weights=va[:, j], minlength=len(pick)) for j in range(LATENT)], 1)
            z = bias + np.bincount(doc, weights=w[at] - 0.5 * (va * va).sum(1), minlength=len(pick)) + 0.5 * (total**2).sum(1)
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick]) / len(pick)
            e = err[doc]
            g = err.sum()
            gb += g * g
            bias -= rate * g / np.sqrt(gb)
            rows_, inv = np.unique(at, return_inverse=True)
            d = np.bincount(inv, weights=e) + l2_w * w[rows_]
            gw[rows_] += d * d
            w[rows_] -= rate * d / np.sqrt(gw[rows_])
            dv = np.stack([np.bincount(inv, weights=e * (total[doc, j] - va[:, j])) for j in range(LATENT)], 1) + l2_v * v[rows_]
            gv[rows_] += dv * dv
            v[rows_] -= 0.3 * rate * dv / np.sqrt(gv[rows_])
    return Machine(place, bias, w.astype(np.float32), v.astype(np.float32))


def held_out(id_col: str):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Machine:
    prepare(spark)
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    rows = rows.orderBy(F.xxhash64("id"), "id").limit(max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"id": b.column("id"), "y": b.column("y"), "x": pa.array([x.tobytes() for x in features(b.column("text").to_pylist())], pa.binary())})

    got = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(rows), "id")
    # a row for each labelled id, whatever rows of documents have it: that with the least features
    got = got.mapInArrow(run, "id long, y int, x binary").groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x")).toArrow().sort_by([("id", "ascending"), ("x", "ascending")])
    return fit([np.frombuffer(x, np.int32) for x in got.column("x").to_pylist()], got.column("y").to_numpy().astype(float))


def score(spark: SparkSession, docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """docs with one more column, score, in place of one of that name. No other column than the text is read for it."""
    prepare(spark)
    docs = docs.drop("score")
    sent = spark.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            s = [m.score(x) for x in features(b.column(text_col).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, "score"])

    from pyspark.sql import types as T

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(spark, docs, train(spark, docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
