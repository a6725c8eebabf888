import random

import pytest

from atlasmill.operators import clumps, conflate, loops

ROWS = "id long, name string, label string, bits int, radius double, lon double, lat double"


@pytest.mark.parametrize("seed", (1, 3))
def test_self_components_against_all_links(spark, seed):
    """Dense, sparse and shared places, the date line, a pole and the equator; missing names, labels and bits."""
    rng = random.Random(seed)
    where = [(12.0, 47.6), (-179.9999, 0.0), (179.9999, 0.0), (30.0, 89.99), (100.0, -60.0)]
    wide = [0.0004, 0.002, 0.006, 0.02][seed]

    def row(i):
        lon, lat = rng.choice(where)
        lon, lat = (lon + 180 + rng.uniform(-wide, wide)) % 360 - 180, min(90.0, lat + rng.uniform(-wide, wide))
        if rng.random() < 0.2:
            lon, lat = round(lon, 3), round(lat, 3)
        return i, rng.choice([None, "", "  ", "cafe", "cafe west", "west cafe", "cafes", "bar"]), rng.choice([None, "", "a", "b"]), rng.choice([None, 0, 1, 2, 3]), rng.choice([15.0, 60.0, 120.0]), lon, lat

    rows = spark.createDataFrame([row(i) for i in range(700)], ROWS).cache()
    all_links = conflate.self_links(rows, "id", "name", "label", "bits", "radius")
    want = dict(loops.components(spark, rows, all_links.select("id", "other"), "id").collect())
    assert len(set(want.values())) < 700
    assert dict(conflate.self_components(spark, rows, "id", "name", "label", "bits", "radius").collect()) == want


def test_links_of_a_crowd_grow_as_its_rows(spark):
    """20,000 rows within 100 m have 1e8 links and more; at most one a row and tile is written, and those of no name stay apart."""
    rng = random.Random(9)
    rows = [(i, None if i % 10 == 0 else "cafe", "a", 1, 100.0, 12 + rng.uniform(0, 0.001), 47 + rng.uniform(0, 0.0006)) for i in range(20_000)]
    frame = spark.createDataFrame(rows, ROWS).cache()
    assert clumps.links(frame, "id", "name", "label", "bits", "radius", conflate.SELF_WEIGHTS, 100.0, 0.75).count() <= 4 * 20_000
    got = dict(conflate.self_components(spark, frame, "id", "name", "label", "bits", "radius").collect())
    assert all(c == (i if i % 10 == 0 else 1) for i, c in got.items()) and len(got) == 20_000


def test_rounds_see_no_link_of_a_row(spark):
    """5,000 rows in four crowds that go over tiles' edges have more than 5,000 links to their tiles' least; those left for the rounds are between tiles."""
    rng = random.Random(4)
    rows = [(i, "cafe", "a", 1, 100.0, 12 + 0.1 * (i % 4) + rng.uniform(0, 0.004), 47 + rng.uniform(0, 0.003)) for i in range(5_000)]
    frame = spark.createDataFrame(rows, ROWS).cache()
    stars = clumps.links(frame, "id", "name", "label", "bits", "radius", conflate.SELF_WEIGHTS, 100.0, 0.75).cache()
    held, left = loops.merged_stars(stars)
    assert stars.count() > 5_000 and held.count() == 5_000 and 0 < left.count() < 200
    got = dict(conflate.self_components(spark, frame, "id", "name", "label", "bits", "radius").collect())
    assert got == {i: i % 4 for i in range(5_000)}


def test_self_dedup_shuffles_no_row_for_its_name(spark):
    from atlasmill.plans import domain

    plan = domain._dense(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_star_components(spark):
    """Stars that meet in a row, one after another; one that meets none; a row without."""
    stars = [(v, v) for v in range(0, 60, 10)] + [(10 * k + i, 10 * k) for k in range(6) for i in range(1, 4)] + [(10 * k + 1, 10 * k + 10) for k in range(4)] + [(20, 3), (3, 3)]
    got = dict(loops.star_components(spark, spark.range(70), spark.createDataFrame(stars, "u long, v long")).collect())
    want = dict(loops.components(spark, spark.range(70), spark.createDataFrame(stars, "u long, v long")).collect())
    assert got == want and len(got) == 70 and got[43] == 0 and got[53] == 50 and got[65] == 65
