import random

import pytest
from pyspark.sql import functions as F

from atlasmill.functions.numeric import haversine
from atlasmill.operators import conflate, history, lookup, loops, spatial


def test_best_pairs_is_greedy(spark):
    rng = random.Random(5)
    pairs = list({(rng.randint(0, 15), rng.randint(0, 15)): (rng.randint(0, 3) / 3, rng.randint(0, 2)) for _ in range(80)}.items())
    rows = [(a, b, s, float(d)) for (a, b), (s, d) in pairs]
    got = conflate.match(spark, spark.createDataFrame(rows, "a long, b long, score double, distance_m double"), "a", "b", 0.3)
    want, ua, ub = set(), set(), set()
    for a, b, s, d in sorted(rows, key=lambda r: (-r[2], r[3], str(r[0]), str(r[1]))):
        if s >= 0.3 and a not in ua and b not in ub:
            want.add((a, b))
            ua.add(a)
            ub.add(b)
    assert {(r.a, r.b) for r in got.collect()} == want


def test_match_in_bands_is_match(spark):
    """Many bands and one, ties of score, rows without a partner."""
    rng = random.Random(8)
    pairs = spark.createDataFrame([(a, b, rng.randint(0, 20) / 20, float(rng.randint(0, 2))) for a in range(30) for b in range(25) if rng.random() < 0.4], "a long, b long, score double, distance_m double").cache()
    score = lambda x, y: pairs.join(x, "a").join(y, "b")
    sides = spark.range(33).toDF("a"), spark.range(28).toDF("b")
    want = {(r.a, r.b) for r in conflate.match(spark, pairs, "a", "b", 0.3).collect()}
    for most in (60, 10**9):
        assert {(r.a, r.b) for r in conflate.match_in_bands(spark, score, *sides, "a", "b", 0.3, most).collect()} == want


def test_ratio_of_few_texts_reads_pairs_once(spark):
    rows = [(1, "red cafe", "cafe red"), (2, None, "bar"), (3, "a", " "), (4, "ab", "ac")]
    pairs = spark.createDataFrame(rows, "k long, a string, b string")
    once, twice = conflate.with_ratio(pairs, "a", "b", "r", (pairs, pairs)), conflate.with_ratio(pairs, "a", "b", "r")
    assert set(once.collect()) == set(twice.collect()) and dict(once.select("k", "r").collect()) == {1: 100.0, 2: None, 3: None, 4: 50.0}


def test_radius_join_against_all_pairs_and_date_line(spark):
    rng = random.Random(1)
    pt = lambda i: (i, rng.choice([-179.999, 179.999, 12.0, -122.3]) + rng.uniform(-0.002, 0.002), rng.choice([0.0, 47.6, 78.0]) + rng.uniform(-0.002, 0.002))
    a, b = [pt(i) for i in range(150)], [pt(i) for i in range(150)]
    left, right = spark.createDataFrame(a, "l long, lon double, lat double"), spark.createDataFrame(b, "r long, lon double, lat double")
    got = {(x.l, x.r) for x in spatial.radius_join(left, right, 150.0, 150.0).collect()}
    full = left.crossJoin(right.toDF("r", "lon2", "lat2")).where(haversine(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")) <= 150)
    assert got == {(x.l, x.r) for x in full.collect()} and got


def test_radius_join_of_one_file_is_many_tasks(spark):
    rows = spark.range(100).select("id", F.lit(12.0).alias("lon"), F.lit(47.0).alias("lat")).coalesce(1)
    assert spatial.radius_join(rows, F.broadcast(rows.withColumnRenamed("id", "other")), 10.0, 10.0).rdd.getNumPartitions() > 1


def test_without_near_against_all_pairs(spark):
    """Rows of most and of less, at the equator, the date line, near a pole and in the south, some without a place."""
    rng = random.Random(3)

    def pt(i):
        lat = rng.choice([0.0, 47.6, 78.0, -60.0]) + rng.uniform(-0.003, 0.003)
        return i, rng.choice([-179.999, 179.999, 12.0]) + rng.uniform(-0.003, 0.003) if rng.random() < 0.95 else None, lat, rng.choice([40.0, 100.0, 150.0, None])

    a, b = [pt(i) for i in range(400)], [pt(i) for i in range(400)]
    left, right = spark.createDataFrame(a, "l long, lon double, lat double, r double").cache(), spark.createDataFrame(b, "q long, lon double, lat double, r2 double").cache()
    met = left.crossJoin(right.toDF("q", "lon2", "lat2", "r2")).where(haversine(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")) <= F.least(F.col("r"), F.lit(100.0)))
    want = set(range(400)) - {x.l for x in met.select("l").distinct().collect()}
    assert {x.l for x in spatial.without_near(left, right, "l", F.col("r"), 100.0).collect()} == want and 20 < len(want) < 380


def test_without_near_joins_no_pairs_of_a_crowd(spark):
    """4e10 pairs within the radius: one row a cell tells."""
    left, right = (spark.range(200_000).select("id", (12 + F.rand(i) / 1000).alias("lon"), (47 + F.rand(i + 2) / 1000).alias("lat")) for i in (1, 2))
    assert spatial.without_near(left, right, "id", 100.0, 100.0).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(50, 60), (60, 55), (1, 1)]
    got = dict(loops.components(spark, spark.range(100), spark.createDataFrame(links, "u long, v long")).collect())
    assert all(got[i] == 10 for i in range(10, 41)) and got[60] == got[55] == 50 and got[99] == 99 and got[1] == 1


VERSIONS = "id long, v long, ts long, added boolean, deleted boolean, closed boolean, reopened boolean, value string"


@pytest.mark.parametrize(
    ("rows", "values", "changed"),
    [
        ([("a", "foo"), ("a", "bar"), ("c", None), ("r", None)], ["foo", "bar", None, "bar"], [1, 1, 1, 1]),
        ([("a", "foo"), ("c", None), ("r", None), ("a", "baz"), ("c", None), ("r", None)], ["foo", None, "foo", "baz", None, "baz"], [1] * 6),
        ([("-", None), ("-", None), ("a", "cafe"), ("a", "cafe2")], ["cafe", "cafe2"], [1, 1]),
        ([("ac", "name")], ["name"], [1]),
        ([("a", "x"), ("cr", None)], ["x", None], [1, 1]),
    ],
)
def test_observations(spark, rows, values, changed):
    data = [(1, i, i, "a" in f, "d" in f, "c" in f, "r" in f, v) for i, (f, v) in enumerate(rows)]
    got = history.observations(spark.createDataFrame(data, VERSIONS), "id", ["v"], "ts").orderBy("v").collect()
    assert [r.tag_value for r in got] == values and [r.changed for r in got] == changed


def test_lookup_and_diff(spark):
    cross = spark.createDataFrame([("shop", "x", "EXCLUDE"), ("shop", "*", "Shop"), ("amenity", "cafe", "Cafe")], "key string, value string, label string")
    rows = spark.createDataFrame([(1, "x", "cafe"), (2, "y", "cafe"), (3, "x", None), (4, None, None)], "id long, shop string, amenity string")
    assert dict(lookup.value_cascade(rows, cross, ["shop", "amenity"]).select("id", "label").collect()) == {1: "Cafe", 2: "Shop", 3: None, 4: None}
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"})], "p map<string,string>, n map<string,string>")
    got = {(x.key, x.value, x.change) for x in df.select(lookup.tag_diff(F.col("p"), F.col("n")).alias("d")).first().d}
    assert got == {("b", "3", "Changed"), ("c", "4", "Added"), ("a", None, "Deleted")}
    with pytest.raises(ValueError):
        lookup.require(rows, ["nope"])


def test_stable_ids(spark):
    release = spark.createDataFrame([(1, ["k1", "k2"]), (2, ["k3"]), (3, ["k9"])], "rid long, keys array<string>")
    reg = spark.createDataFrame([("k1", "A", "1", "r1"), ("k2", "B", "2", "r1"), ("k3", "C", "3", "r1"), ("k4", "D", "4", "r1")], "source_key string, unified_id string, id_minted string, last_release string")
    ids, log = conflate.stable_ids(spark, release, reg, F.concat(F.lit("new"), F.col("rid").cast("string")))
    assert {r.rid: (r.unified_id, r.carried) for r in ids.collect()} == {1: ("A", True), 2: ("C", True), 3: ("new3", False)}
    assert {(r.old_id, r.new_id, r.change) for r in log.collect()} == {("B", "A", "merged_into"), ("D", None, "retired"), (None, "new3", "minted")}


def test_ids_by_alias_with_clashes_over_releases(spark):
    reg = spark.createDataFrame([("a1", "u1", "r0", "r1", False), ("a2", "u2", "r0", "r1", False), ("a9", "u9", "r0", "r0", True), ("a8", "new3", "r0", "r1", False)], "source_key string, unified_id string, id_minted string, last_release string, retired boolean")
    release = spark.createDataFrame([(1, ["a1"]), (2, ["b2"]), (3, ["c3"]), (4, ["a9"])], "rid long, keys array<string>")
    aliases = spark.createDataFrame([("a2", "b2")], "loser_key string, winner_key string")
    mint = lambda salt: F.concat(F.lit("new"), F.col("rid").cast("string"), F.lit(f"+{salt}" if salt else ""))
    ids, log = conflate.stable_ids(spark, release, reg, mint, aliases)
    assert {(r.rid, r.unified_id, r.carried) for r in ids.collect()} == {(1, "u1", True), (2, "u2", True), (3, "new3+1", False), (4, "u9", True)}
    assert {tuple(r) for r in log.collect()} == {("new3", None, "retired"), (None, "new3+1", "minted"), ("u9", "u9", "revived")}
    after = {r.source_key: (r.unified_id, r.id_minted, r.last_release, r.retired) for r in conflate.next_registry(release, ids, reg, "r2").collect()}
    assert after == {"a1": ("u1", "r0", "r2", False), "b2": ("u2", "r0", "r2", False), "c3": ("new3+1", "r2", "r2", False), "a9": ("u9", "r0", "r2", False), "a2": ("u2", "r0", "r1", False), "a8": ("new3", "r0", "r1", True)}


def test_replay_of_deletions(spark):
    base = spark.createDataFrame([(1, 3, True), (2, 5, False)], "id long, version long, visible boolean")
    rows = [(1, 1, 3, "t", "c1", False), (1, 2, None, None, "c2", True), (1, 3, None, None, "c3", True), (1, 4, 5, "t4", "c4", False), (2, 1, None, None, "c1", True), (3, 1, 1, "t1", "c1", False)]
    window = spark.createDataFrame(rows, "id long, seq long, version long, at string, cut string, deleted boolean")
    got = {(r.id, r.version, r["at"], r.visible) for r in history.replay(base, window, "id", "seq").collect()}
    assert got == {(1, 4, "c2", False), (1, 5, "t4", True), (3, 1, "t1", True)}
