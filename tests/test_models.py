import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasmill.operators import cells, models


def test_monotone_matrices():
    rng = np.random.default_rng(1)
    for _ in range(5):
        v, w = rng.normal(size=(4, 5)).cumsum(axis=1) * 0.5, rng.uniform(0.5, 2, (4, 5))
        x = models.monotone(v, w, 5000, 1e-12)
        assert (np.diff(x, axis=0) > -1e-6).all() and (np.diff(x, axis=1) > -1e-6).all()
        best = (w * (x - v) ** 2).sum()
        for _ in range(200):  # nothing near it that is monotone is nearer
            y = np.maximum.accumulate(np.maximum.accumulate(x + rng.normal(0, 0.05, x.shape), 0), 1)
            assert (w * (y - v) ** 2).sum() >= best - 1e-6


def test_pooled_scores_are_recovered():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(2, 20_000))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.3 + 0.9 * a + 0.4 * b)))).astype(float)
    assert models.fit_pool(a, b, y, np.ones(20_000)) == pytest.approx([0.3, 0.9, 0.4], abs=0.06)
    low = models.fit_pool(a, -b, y, np.ones(20_000))
    assert low[2] == pytest.approx(0.001) and low[1] > 0.5


def test_samplers_find_a_normal():
    cov = np.array([[2.0, 0.8], [0.8, 1.0]])
    inv = np.linalg.inv(cov)
    draws = models.sample(lambda x: -0.5 * float((x - 3) @ inv @ (x - 3)), np.zeros(2), 2000, 8000, 4)
    flat = draws.reshape(-1, 2)
    assert flat.mean(0) == pytest.approx([3, 3], abs=0.2) and np.cov(flat.T) == pytest.approx(cov, abs=0.35)
    assert (models.r_hat(draws) < 1.03).all() and (models.effective(draws) > 800).all()
    assert models.r_hat(np.stack([np.zeros((50, 1)) + np.arange(50)[:, None] % 2, 9.0 + np.arange(50)[:, None] % 2]))[0] > 2
    white = np.random.default_rng(3).normal(size=(4, 2000, 1))
    assert models.effective(white)[0] == pytest.approx(8000, rel=0.2)


def test_random_rates_of_cells(spark):
    rng = np.random.default_rng(4)
    rates, rows = {"a": 0.2, "b": 0.6, "c": 1.2}, []
    for c, r in rates.items():
        for _ in range(1500):
            t = float(rng.uniform(0.2, 2))
            rows.append((c, t, False, bool(rng.random() < 1 - np.exp(-r * t))))
    df = spark.createDataFrame(rows, "c string, t double, first boolean, changed boolean")
    names, draws = models.fit_random_rates(*cells.sufficient_stats(df, ["c"], "t", "first", "changed"), "c", "t", warm=3000, draws=4000, chains=2)
    assert np.exp(draws[:, :, 2:].mean(axis=(0, 1))) == pytest.approx([rates[n] for n in names], rel=0.12)


def test_models_by_name(spark):
    models.register_model("half", lambda a, b, p: F.lit(p["x"]) / 2)
    r = spark.range(1).select(models.chance("half", F.lit(0), F.lit(1), {"x": 0.5}), models.chance("constant", F.lit(0.0), F.lit(1.0), {"rate": 0.0})).first()
    assert r[:] == (0.25, 0.0)
    with pytest.raises(ValueError):
        models.chance("none", F.lit(0), F.lit(1), {})
