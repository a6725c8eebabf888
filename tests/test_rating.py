import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasmill.operators import rating


def test_pool_is_the_nearest_rising_fit():
    rng = random.Random(2)
    for _ in range(30):
        v = np.array([rng.uniform(0, 1) for _ in range(rng.randint(1, 12))])
        w = np.array([rng.uniform(0.1, 3) for _ in v])
        mean = lambda a, b: (v[a : b + 1] * w[a : b + 1]).sum() / w[a : b + 1].sum()  # noqa: B023, E731
        want = [max(min(mean(a, b) for b in range(i, len(v))) for a in range(i + 1)) for i in range(len(v))]
        assert np.allclose(rating.pool(v, w), want)


def test_pointwise_and_loglik(spark):
    df = spark.createDataFrame([([-700.0, -701.0, -699.5],)], "l array<double>")
    lppd, var = df.select(*rating.pointwise(F.col("l"))).first()
    x = np.array([-700.0, -701.0, -699.5])
    assert math.isclose(lppd, -700 + math.log(np.exp(x + 700).mean())) and math.isclose(var, x.var(ddof=1))
    row = spark.range(1).select(rating.zie_loglik(F.lit(0.3), F.lit(True), F.lit(0.1), F.lit(True)).alias("a"), rating.zie_loglik(F.lit(0.3), F.lit(False), F.lit(0.1), F.lit(False)).alias("b")).first()
    assert math.isclose(row.a, math.log(1 - 0.9 * math.exp(-0.3))) and math.isclose(row.b, -0.3)


def test_cell_curves_with_unknown_and_null_levels(spark):
    rows = spark.createDataFrame([(1, "a", 2), (2, "b", 2), (3, None, 2)], "id long, label string, t int")
    base = spark.createDataFrame([(0, math.log(0.1)), (1, math.log(0.2))], "draw long, value double")
    eff = spark.createDataFrame([("a", 0, math.log(2)), ("a", 1, math.log(2))], "label string, draw long, value double")
    got = {r.id: r.conf_mean for r in rating.cell_curves(rows, base, {"label": eff}, "t").collect()}
    plain = (math.exp(-0.2) + math.exp(-0.4)) / 2
    assert math.isclose(got[1], (math.exp(-0.4) + math.exp(-0.8)) / 2) and math.isclose(got[2], plain) and math.isclose(got[3], plain)


def test_empty_cells_and_falls(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, 1.0), (0, 0, 3.0)], "i int, j int, x double")
    got = {(r.i, r.j): r.mean for r in rating.cell_means(rows, "x", "i", "j", (2, 2)).collect()}
    assert got[0, 0] == 2.0 and all(math.isnan(got[k]) for k in ((0, 1), (1, 0), (1, 1)))
    curve = spark.createDataFrame([("s", 0.0, 0.1), ("s", 1.0, 0.3), ("s", 2.0, 0.2), ("u", 0.0, 0.05)], "seg string, at double, p double")
    assert [r["at"] for r in rating.falls(curve, "seg", "at", "p").collect()] == [2.0]
    with pytest.raises(ValueError):
        rating.export_curves(curve, "seg", "at", "p", str(tmp_path / "c"))


def test_urban_class(spark):
    rows = spark.createDataFrame([(200_000, 1500.0), (200_000, 800.0), (200_000, None), (100, 1500.0), (None, 600.0)], "p long, d double")
    assert [r.k for r in rows.select(rating.urban_class(F.col("p"), F.col("d")).alias("k")).collect()] == ["urban", "suburban", "rural", "suburban", "suburban"]
