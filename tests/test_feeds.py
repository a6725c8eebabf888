import gzip
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from atlasmill.operators import releases
from atlasmill.sources import datasets
from atlasmill.streaming import feed


def test_roll_over_two_runs(spark, tmp_path):
    write = lambda rows: spark.createDataFrame(rows, "id long, version long, x string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    write([(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (2, 5, None), (None, 1, "n"), (3, None, "z")])
    run = lambda: {tuple(r) for r in feed.drain(feed.roll(feed.read(spark, str(tmp_path / "in")), ["id"], "version"), str(tmp_path / "out")).collect()}
    first = run()
    assert first == {(1, 1, "a"), (1, 2, "b"), (2, 5, None), (None, 1, "n")}
    write([(1, 2, "again"), (1, 3, "c"), (2, 4, "old"), (4, 1, "new")])
    assert run() == first | {(1, 3, "c"), (4, 1, "new")}


def test_observe_keeps_state_between_runs(spark, tmp_path):
    schema = "id long, v long, t timestamp, added boolean, deleted boolean, closed boolean, reopened boolean, value string"
    at = lambda i: datetime(2020, 1, 1 + i)
    runs = [[(0, "-", None), (1, "a", "foo"), (2, "a", "bar")], [(3, "c", None), (4, "r", None)]]
    for rows in runs:
        data = [(7, i, at(i), "a" in f, "d" in f, "c" in f, "r" in f, v) for i, f, v in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = feed.drain(feed.observe(feed.read(spark, str(tmp_path / "in")), "id", "v", "t"), str(tmp_path / "out")).orderBy("v").collect()
    assert [(r.v, r.tag_value, r.changed) for r in got] == [(1, "foo", 1), (2, "bar", 1), (3, None, 1), (4, "bar", 1)]
    assert [r.last_at for r in got][0] is None and got[2].last_at == at(2)


def test_sequence_and_chain(spark):
    numbers = lambda *x: spark.createDataFrame([(i,) for i in x], "seq long")
    feed.require_sequence(numbers(5, 6, 6, 7), "seq")
    feed.require_sequence(numbers(5, 6, 7), "seq", 4)
    feed.require_sequence(numbers(), "seq", 4)
    for bad, last in ((numbers(5, 7), None), (numbers(6, 7), 4)):
        with pytest.raises(feed.FeedGap):
            feed.require_sequence(bad, "seq", last)
    feed.require_chain(date(2020, 3, 15), date(2021, 3, 14))
    with pytest.raises(feed.FeedGap):
        feed.require_chain(date(2020, 3, 15), date(2021, 3, 15))


DIFF = """<osmChange version="0.6"><create><node id="1" version="1" timestamp="t1" lat="1.0" lon="2.0"><tag k="shop" v="x"/></node><node id="2" version="1" timestamp="t1" lat="1" lon="2"/></create>
<modify><node id="3" version="2" timestamp="t2" lat="1" lon="2"/><way id="4" version="3" timestamp="t2"><nd ref="1"/><tag k="a" v="b"/><tag k="c" v="d"/></way></modify>
<delete><node id="5" version="1" timestamp="t3"/></delete></osmChange>"""


def test_diffs(spark, tmp_path):
    with gzip.open(tmp_path / "000123.osc.gz", "wt") as f:
        f.write(DIFF)
    got = {r.id: r for r in datasets.read_diffs(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 3, 4, 5} and {r.seq for r in got.values()} == {123}
    assert got[5].deleted and not got[1].deleted and got[4].type == "way" and [t.k for t in got[4].tags] == ["a", "c"] and got[3].tags == []


def test_partitioned(spark, tmp_path):
    rows = spark.createDataFrame([("01", 2), ("01", 1), ("1e", 3), (None, 4), ("a/b c", 5)], "label string, k long")
    datasets.write_partitioned(rows, str(tmp_path / "d"), "label", "k")
    got = datasets.read_partitioned(spark, str(tmp_path / "d"), by="label")
    assert {(r.label, r.k) for r in got.collect()} == {("01", 1), ("01", 2), ("1e", 3), ("a/b c", 5)}
    assert [r.k for r in datasets.read_partitioned(spark, str(tmp_path / "d"), "1e", "label").collect()] == [3]


def test_releases(spark):
    old = spark.createDataFrame([("k1", "A", "1"), ("k2", "B", "2")], "source_key string, unified_id string, id_minted string")
    release = spark.createDataFrame([(1, ["k2", "k1"]), (2, ["k9"]), (3, None)], "rid long, keys array<string>")
    assert {r.rid: r.unified_id for r in releases.replay(release, old).collect()} == {1: "A", 2: None, 3: None}
    new = old.where("source_key = 'k1'").withColumn("unified_id", F.lit("Z"))
    assert [tuple(r) for r in releases.migration(old, new).collect()] == [("A", "Z")]
    assert tuple(releases.mismatches(old, new, "source_key", ["unified_id", "id_minted"]).first()) == (1, 0, 1, 0)


def test_shadow_matches(spark):
    ghosts = spark.createDataFrame(
        [(1, -122.0, 47.0, "Walgreens", None, None, "shop"), (2, -122.0, 47.1, "Joe's Cafe", None, "Kangam Cafe", "cafe"), (3, -122.0, 47.2, None, None, None, "x")],
        "ghost long, lon double, lat double, name string, brand string, new_name string, label string",
    )
    others = spark.createDataFrame(
        [(10, -122.0, 47.0001, "Walgreens Pharmacy", None, "shop"), (11, -122.0, 47.0001, "Zephyr Grocery", None, "shop"), (12, -122.0, 47.1, "Kangnam Cafe", None, "cafe"), (13, -122.0, 47.2, "Anything", None, "x")],
        "other long, lon double, lat double, name2 string, brand2 string, label2 string",
    )
    assert [(r.ghost, r.other) for r in releases.shadow_matches(spark, ghosts, others).collect()] == [(1, 10)]
