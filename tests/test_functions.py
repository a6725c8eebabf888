import hashlib
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from atlasmill.functions import fuzzy, geometry, numeric, text


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Nettle & Quill", "nettle quill", True),  # equal once plain
        ("Ostrava Bank", "Ostrava", True),  # tokens of one within the other
        ("Ostrava Bank", "Lisbon Bank", False),  # a category that both end in is no evidence
        ("Tamsin Vole Books", "Tamsin Voles Books", True),  # alike letters
        ("Ridgeway Ltd", "Ridgeway", True),  # legal form
        ("Copper Kettle", "Velvet Anchor", False),
        ("Salon", "Salon", True),  # a category that is all there is
        ("", "Copper Kettle", False),
        (None, None, False),
    ],
)
def test_same_name(a, b, same):
    assert fuzzy.same_name(a, b) is same


@pytest.mark.parametrize(("raw", "plain"), [("Crème Brûlée Hut", "creme brulee hut"), ("Oakum Trading Co.", "oakum trading"), ("Oakum Trading, Ltd", "oakum trading"), ("Ltd", "ltd"), ("9th & Pine", "9th pine"), (None, "")])
def test_plain_name(raw, plain):
    assert fuzzy.plain_name(raw) == plain


def test_names_for_display_and_groups(spark):
    df = spark.createDataFrame([("corner_shop", ["a", "b"], "x", "", 0.2, 0.9), ("hall", [], "", "y", 0.9, 0.2)], "s string, p array<string>, a string, b string, ca double, cb double")
    r = df.select(text.title("s", F.lit(3)), text.path("p"), text.group_key("s", "a"), numeric.blend(F.col("a"), F.col("b"), F.col("ca"), F.col("cb")), numeric.logit(F.col("ca")), text.token_subset(F.lit("a b"), F.lit("b")), text.token_subset(F.lit("a b"), F.lit("b c"))).collect()
    assert [list(x)[:4] for x in r] == [["Corner Shop (N = 3)", "a > b", "corner_shop\x1fx", "x"], ["Hall (N = 3)", None, "hall\x1f", "y"]]
    assert r[0][4] == pytest.approx(math.log(0.25)) and r[0][5] and not r[0][6]


def test_functions_for_sql(spark):
    fuzzy.register(spark)
    assert spark.sql("SELECT plain_name('Ünder Ltd') AS p, same_name('a b', 'b a') AS s, set_ratio('a b', 'a') AS r").first()[:] == ("under", True, 100.0)


def test_hilbert_curve_visits_neighbours(spark):
    side = 16
    cells = [(x, y, (x + 0.5) * 360 / side - 180, (y + 0.5) * 180 / side - 90) for x in range(side) for y in range(side)]
    df = spark.createDataFrame(cells, "x int, y int, lon double, lat double")
    at = {r.h: (r.x, r.y) for r in df.select("x", "y", geometry.hilbert(F.col("lon"), F.col("lat"), 4).alias("h")).collect()}
    assert sorted(at) == list(range(side * side)) and all(abs(at[i][0] - at[i + 1][0]) + abs(at[i][1] - at[i + 1][1]) == 1 for i in range(side * side - 1))


def test_geometry():
    hole = [(2, 2), (3, 2), (3, 3), (2, 3)]
    ring = [(0, 0), (4, 0), (4, 4), (0, 4)]
    x, y = geometry.centre([ring, hole], 3)
    assert (x, y) == pytest.approx(((16 * 2 - 2.5) / 15, (16 * 2 - 2.5) / 15))
    px, py = geometry.inner_point([ring, hole])
    assert 0 < px < 4 and 0 < py < 4 and not (2 <= px <= 3 and 2 <= py <= 3)
    assert geometry.centre([[(0, 0), (2, 0), (2, 2)]], 2) == pytest.approx((1.5, 0.5))
    line = bytes([0]) + struct.pack(">IIdddd", 2, 2, 1, 2, 3, 4)
    assert geometry.rings_of(line) == [[(1.0, 2.0), (3.0, 4.0)]]
    many = bytes([1]) + struct.pack("<II", 6, 1) + bytes([1]) + struct.pack("<III", 3, 1, 2) + struct.pack("<4d", 1, 2, 3, 4)
    assert geometry.rings_of(many) == [[(1.0, 2.0), (3.0, 4.0)]]


def test_stable_seed(spark):
    got = spark.createDataFrame([("a", "b")], "t string, n string").select(geometry.stable_seed("t", "n")).first()[0]
    assert int(got) == int.from_bytes(hashlib.blake2b(b"a\x1fb", digest_size=8).digest(), "big")


def test_indel_ratio_against_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for j, y in enumerate(b):
                row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
        want = 200 * row[-1] / (len(a) + len(b)) if a or b else 100
        assert abs(fuzzy.indel_ratio(a, b) - want) < 1e-9


def test_mint():
    assert fuzzy.mint("ovt:x").startswith("am_") and len(fuzzy.mint("ovt:x")) == 19
    assert hashlib.blake2b(b"ovt:x", digest_size=10).digest()


def test_columns(spark):
    df = spark.createDataFrame([(" HTTPS://www.Example.com/a/?q=1#x ", "+1 (555) 000-1234", "q42")], "u string, p string, w string")
    r = df.select(text.website("u"), text.phone("p"), text.wikidata("w"), text.matcher_name("u"), numeric.geohash(F.lit(-122.335), F.lit(47.608)), text.without_last_of(F.lit("blue harbor bank"), ["bank"])).first()
    assert list(r) == ["example.com/a", "5550001234", "Q42", "https://www.example.com/a/?q=1#x", "c23nb4", "blue harbor"]
    with pytest.raises(ValueError):
        text.identifier("fax", "u")
