import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasmill.operators import cells, filters
from atlasmill.sources import files


def test_running_sums_and_quantiles_against_numpy(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("abc"), rng.choice([None, 1.0, 2.5, rng.random() * 9])) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, g string, x double")
    got = {r.i: r.s for r in cells.running_sum(spark, df, ["i"], F.col("i") * 2, "s").collect()}
    assert got == {i: i * (i + 1) for i in range(500)}
    own = {r.i: r.n for r in cells.places(spark, df, ["g"], ["i"], "n").collect()}
    assert own == {i: sum(a <= i and h == g for a, h, _ in rows) for i, g, _ in rows}
    for r in cells.quantiles(spark, df, ["g"], "x", [0.0, 0.1, 0.5, 0.77, 1.0]).collect():
        assert r.q == pytest.approx(np.quantile([x for _, g, x in rows if g == r.g and x is not None], [0.0, 0.1, 0.5, 0.77, 1.0]).tolist())
    none = df.limit(0)
    assert cells.dense_ids(spark, none, ["i"]).count() == 0 and cells.quantiles(spark, none, ["g"], "x", [0.5]).count() == 0


def test_bins_of_atoms():
    counts = [(0.1, 50), (0.2, 1), (0.3, 2), (0.4, 2), (0.5, 45)]
    values = np.repeat([v for v, _ in counts], [n for _, n in counts])
    assert [cells.quantile(counts, q) for q in (0, 0.2, 0.505, 0.53, 1)] == pytest.approx(np.quantile(values, [0, 0.2, 0.505, 0.53, 1]).tolist())
    edges = cells.atom_bins(counts, 2)
    assert [e for e, atom in edges if atom] == [0.1, 0.5] and any(e == pytest.approx(0.1 + 1e-6) for e, _ in edges)
    sizes = [sum(n for v, n in counts if e <= v and (i + 1 == len(edges) or v < edges[i + 1][0])) for i, (e, _) in enumerate(edges)]
    assert sum(sizes) == 100
    merged = cells.merge_thin(edges, sizes, 5)
    assert merged[0] == (0.1, 50) and merged[-1] == (0.5, 45) and [n for _, n in merged] == [50, 5, 45]
    assert cells.merge_thin([(0.0, False), (1.0, False)], [1, 2], 9) == [(0.0, 1), (1.0, 2)]
    assert cells.merge_thin([(0.0, True), (1.0, False)], [1, 9], 5) == [(0.0, 10)]


def test_budget_takes_one_at_least(spark):
    df = spark.createDataFrame([(1, i) for i in range(9)] + [(2, i) for i in range(9)], "k int, i int")
    assert cells.budget(spark, df, "k", 1).count() == 9 and cells.budget(spark, df, "k", 100).count() == 18


def test_checked_ranges(spark):
    df = spark.createDataFrame([(0.5,), (1.0,)], "c double")
    assert filters.require_range(df, "c").count() == 2
    for bad in (None, -0.1, 1.5):
        with pytest.raises(ValueError):
            filters.require_range(df.unionByName(spark.createDataFrame([(bad,)], "c double")), "c")
    assert spark.createDataFrame([(None,)], "t timestamp").where(filters.recent(F.col("t"), F.current_timestamp(), 1)).count() == 1
    assert df.where(filters.recent(F.lit("1990-01-01").cast("timestamp"), F.current_timestamp(), None)).count() == 2


def test_diff_plan():
    start = datetime(2026, 1, 1)
    stamp = lambda n: start + timedelta(days=n)
    assert list(files.plan_sequences(stamp, start + timedelta(days=3), start + timedelta(days=6, hours=5), 100)) == [4, 5, 6]
    assert list(files.plan_sequences(stamp, start + timedelta(days=99), start + timedelta(days=500), 100)) == [100]
    assert not files.plan_sequences(stamp, start + timedelta(days=7), start + timedelta(days=7), 100)


def test_files(spark, tmp_path):
    d = f"file://{tmp_path}"
    assert files.read_json(spark, f"{d}/coverage.json") is None
    files.write_json(spark, f"{d}/coverage.json", {"mode": "full", "end": "2026-01-01"})
    assert files.require_full(files.read_json(spark, f"{d}/coverage.json"))["end"] == "2026-01-01"
    with pytest.raises(ValueError):
        files.require_full({"mode": "diff"})
    spark.range(10).withColumn("x", F.col("id") * 2).write.parquet(f"{d}/t")
    with pytest.raises(ValueError):
        files.rewrite(spark, f"{d}/t", lambda df: df.drop("x"))
    files.rewrite(spark, f"{d}/t", lambda df: df.withColumn("y", F.lit(1)))
    assert spark.read.parquet(f"{d}/t").agg(F.sum("x"), F.sum("y")).first()[:] == (90, 10)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["coverage.json", "t"]
    files.write_bounded(spark.range(100).coalesce(1), f"{d}/b", file_rows=30)
    assert len(files.part_keys(spark, f"{d}/b")) == 4 and files.head(spark.range(9), 2).count() == 2
    with pytest.raises(FileNotFoundError):
        files.latest_release(spark, f"{d}/b")
    assert files.pipe_table(["a", "b"], [(1, "x|y"), (None, 2)]).splitlines() == ["| a | b |", "|--|--|", "| 1 | x\\|y |", "|  | 2 |"]


def test_files_are_ranges_of_the_curve(spark, tmp_path):
    from atlasmill.functions.geometry import hilbert

    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.uniform(-120, -110), rng.uniform(30, 40)) for i in range(400)], "i int, lon double, lat double")
    files.write_by_curve(df, f"file://{tmp_path}/c", F.col("lon"), F.col("lat"), 4)
    parts = [[r[0] for r in spark.read.parquet(p).select(hilbert(F.col("lon"), F.col("lat"))).collect()] for p in files.part_keys(spark, f"file://{tmp_path}/c")]
    spans = sorted((min(x), max(x)) for x in parts if x)
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)) and all(x == sorted(x) for x in parts)
