"""Entity resolution, history and confidence operators on stand-ins derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.functions import fuzzy, numeric, text
from atlasmill.operators import conflate, history, lookup, spatial
from atlasmill.plans.registry import query
from atlasmill.session import table


def _at(key: str, a: int, b: int) -> tuple[Column, Column]:
    return -122.45 + F.pmod(F.col(key) * a, F.lit(10007)) * 0.00002, 47.5 + F.pmod(F.col(key) * b, F.lit(10009)) * 0.00002


def _left(spark: SparkSession, d: str, *more: Column) -> DataFrame:
    lon, lat = _at("c_custkey", 7919, 5641)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("osm"), (F.col("c_nationkey") % 5).alias("kind"), F.col("c_acctbal").alias("bal"), lon.alias("lon"), lat.alias("lat"), *more)


def _names(left: bool) -> tuple[Column, ...]:
    """Names, brands and identifiers, missing ones among them."""
    key = F.col("c_custkey" if left else "p_partkey")
    name = F.when(key % (4 if left else 5) != 0, F.lower("c_mktsegment" if left else "p_type"))
    phone = F.when(key % (3 if left else 2) == 0, (key % 40).cast("string"))
    brand = F.concat(F.lit("b"), (key % 3).cast("string"))
    x = "1" if left else "2"
    return name.alias(f"name{x}"), brand.alias(f"brand{x}"), phone.alias(f"phone{x}")


def _dense(spark: SparkSession, d: str) -> DataFrame:
    """The left side with about one other within 100 m of each at 1,500 rows."""
    c = table(spark, d, "customer")
    lon, lat = (base + F.pmod(F.col("c_custkey") * k, F.lit(m)) * 0.00002 for base, k, m in ((-122.45, 7919, 1009), (47.5, 5641, 1013)))
    name = F.when(F.col("c_custkey") % 4 != 0, F.lower("c_mktsegment"))
    return c.select(F.col("c_custkey").alias("osm"), (F.col("c_nationkey") % 5).alias("kind"), F.col("c_acctbal").alias("bal"), lon.alias("lon"), lat.alias("lat"), name.alias("name1"))


def _right(spark: SparkSession, d: str, *more: Column) -> DataFrame:
    lon, lat = _at("p_partkey", 6287, 8713)
    return table(spark, d, "part").select(F.col("p_partkey").alias("ovt"), (F.col("p_size") % 5).alias("other"), F.col("p_retailprice").alias("price"), lon.alias("lon"), lat.alias("lat"), *more)


L = "SELECT c_custkey AS osm, c_nationkey % 5 AS kind, c_acctbal AS bal, -122.45 + ((c_custkey * 7919) % 10007) * 0.00002 AS lon, 47.5 + ((c_custkey * 5641) % 10009) * 0.00002 AS lat FROM customer"
R = "SELECT p_partkey AS ovt, p_size % 5 AS other, p_retailprice AS price, -122.45 + ((p_partkey * 6287) % 10007) * 0.00002 AS lon2, 47.5 + ((p_partkey * 8713) % 10009) * 0.00002 AS lat2 FROM part"
DIST = "2 * 6371000.0 * asin(sqrt(least(1.0, sin((radians(lat2) - radians(lat)) / 2) ** 2 + cos(radians(lat)) * cos(radians(lat2)) * sin((radians(lon2) - radians(lon)) / 2) ** 2)))"
PAIRS = f"SELECT osm, ovt, kind, other, bal, price, d FROM (SELECT *, {DIST} AS d FROM ({L}) a, ({R}) b WHERE lat2 BETWEEN lat - 0.002 AND lat + 0.002) WHERE d <= least(100 + kind * 40, 200)"
DENSE = "SELECT c_custkey AS osm, c_nationkey % 5 AS kind, c_acctbal AS bal, CASE WHEN c_custkey % 4 <> 0 THEN lower(c_mktsegment) END AS name, -122.45 + ((c_custkey * 7919) % 1009) * 0.00002 AS lon, 47.5 + ((c_custkey * 5641) % 1013) * 0.00002 AS lat FROM customer"


def _apart(a: str, b: str) -> float:
    """Indel ratio by the plain recurrence, for the SQL's table of ratios."""
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return 200 * row[-1] / (len(a) + len(b))


SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")
TYPES = ("economy", "large", "medium", "promo", "small", "standard")
RATIOS = "(VALUES " + ", ".join(f"('{a}', '{b}', {_apart(a, b)!r}::DOUBLE)" for a in SEGMENTS for b in sorted({*SEGMENTS, *TYPES})) + ") r(a, b, ratio)"
BEST = "greatest(r.ratio, CASE WHEN osm % 3 = ovt % 3 THEN 100 ELSE 50 END) / 100"
KIND = "CASE WHEN kind = other THEN 1.0 WHEN ((1 << (kind % 3)::INT) & (1 << (other % 3)::INT)) <> 0 THEN 0.5 ELSE 0.0 END"
SAME = "CASE WHEN osm % 40 = ovt % 40 THEN 1.0 ELSE 0.0 END"
NEAR = "greatest(0.0, least(1.0, 1 - d / (100 + kind * 40)))"
SCORED = f"""SELECT osm, ovt, d, CASE WHEN osm % 3 = 0 AND ovt % 2 = 0 THEN 0.1667 * {NEAR} + 0.3333 * {BEST} + 0.3333 * {KIND} + 0.1667 * {SAME} ELSE 0.2 * {NEAR} + 0.4 * {BEST} + 0.4 * {KIND} END AS score
 FROM ({PAIRS}) p JOIN customer ON osm = c_custkey JOIN part ON ovt = p_partkey LEFT JOIN {RATIOS} ON r.a = CASE WHEN osm % 4 <> 0 THEN lower(c_mktsegment) END AND r.b = CASE WHEN ovt % 5 <> 0 THEN lower(p_type) END"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return spatial.radius_join(_left(spark, d), _right(spark, d), (100 + F.col("kind") * 40).cast("double"), 200.0)


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with their names, brands and identifiers."""
    return _left(spark, d, *_names(True)).drop("bal"), _right(spark, d, *_names(False)).drop("price")


def _scored(left: DataFrame, right: DataFrame) -> DataFrame:
    near = conflate.distance_score(F.col("distance_m"), 100 + F.col("kind") * 40)
    bits = lambda c: F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), (F.col(c) % 3 + 1).cast("int"))
    kind = conflate.type_score(F.col("kind").cast("string"), F.col("other").cast("string"), bits("kind"), bits("other"))
    pairs = spatial.radius_join(left, right, (100 + F.col("kind") * 40).cast("double"), 200.0)
    pairs = conflate.with_ratio(conflate.with_ratio(pairs, "name1", "name2", "names", (left, right)), "brand1", "brand2", "brands", (left, right))
    same, comparable = conflate.identifier_score([(F.col("phone1"), F.col("phone2"))])
    score = conflate.composite(near, conflate.name_score([F.col("names"), F.col("brands")]), kind, same, comparable)
    return pairs.select("osm", "ovt", "distance_m", score.alias("score"))


def _matched(spark: SparkSession, d: str) -> DataFrame:
    left, right = _sides(spark, d)
    bits = lambda c: F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), (F.col(c) % 3 + 1).cast("int"))
    left = left.withColumns({"bits1": bits("kind"), "radius": (100 + F.col("kind") * 40).cast("double")})
    return conflate.match_near(spark, left, right.withColumn("bits2", bits("other")), "osm", "ovt", [("name1", "name2"), ("brand1", "brand2")], ("kind", "other"), ("bits1", "bits2"), [("phone1", "phone2")], "radius", 200.0, 0.5)


@query(f"SELECT osm, ovt, round(d, 6) AS distance_m FROM ({PAIRS})")
def j6_radius_join(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("osm", "ovt", F.round("distance_m", 6).alias("distance_m"))


def _two(expr: str) -> str:
    """The distance between a row of a and one of b."""
    return expr.replace("lat2", "b.lat").replace("lon2", "b.lon").replace("(lat)", "(a.lat)").replace("(lon)", "(a.lon)")


CLOSE = f"SELECT a.osm AS osm, b.osm AS other, a.kind AS k1, b.kind AS k2, a.name AS n1, b.name AS n2, {_two(DIST)} AS d FROM ({DENSE}) a JOIN ({DENSE}) b ON a.osm < b.osm AND b.lat BETWEEN a.lat - 0.001 AND a.lat + 0.001 WHERE {_two(DIST)} <= 100"
TWINS = f"""SELECT osm, other, score FROM (SELECT osm, other, 0.3 * greatest(0.0, least(1.0, 1 - d / greatest(60 + k1 * 20, 60 + k2 * 20))) + 0.5 * coalesce(r.ratio / 100, 0.5) + 0.2 * {KIND.replace('kind', 'k1').replace('other', 'k2')} AS score
 FROM ({CLOSE}) LEFT JOIN {RATIOS} ON r.a = n1 AND r.b = n2) WHERE score >= 0.75"""


@query(f"SELECT osm, other, round(d, 3) AS distance_m FROM ({CLOSE})")
def j6b_radius_self_join(spark: SparkSession, d: str) -> DataFrame:
    return spatial.radius_self_join(_dense(spark, d), "osm", 100.0).select("osm", "other", F.round("distance_m", 3).alias("distance_m"))


@query(f"SELECT osm FROM ({L}) WHERE osm NOT IN (SELECT osm FROM ({PAIRS}) WHERE d <= 100)")
def j6c_survivors(spark: SparkSession, d: str) -> DataFrame:
    return spatial.without_near(_left(spark, d), _right(spark, d), "osm", (100 + F.col("kind") * 40).cast("double"), 100.0).select("osm")


@query(f"SELECT osm, ovt, round(d, 6) AS distance_m, round(score, 6) AS score FROM ({SCORED})")
def d1_d5_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(*_sides(spark, d)).select("osm", "ovt", F.round("distance_m", 6).alias("distance_m"), F.round("score", 6).alias("score"))


def _rounds(n: int) -> str:
    """Mutual-best rounds, unrolled."""
    order = "ORDER BY score DESC, d, osm::VARCHAR, ovt::VARCHAR"
    parts = [f"p0 AS MATERIALIZED (SELECT * FROM ({SCORED}) WHERE score >= 0.5)"]
    for i in range(n):
        parts.append(f"t{i} AS MATERIALIZED (SELECT osm, ovt, d, score FROM (SELECT *, row_number() OVER (PARTITION BY osm {order}) AS a, row_number() OVER (PARTITION BY ovt {order}) AS b FROM p{i}) WHERE a = 1 AND b = 1)")
        parts.append(f"p{i + 1} AS MATERIALIZED (SELECT * FROM p{i} WHERE osm NOT IN (SELECT osm FROM t{i}) AND ovt NOT IN (SELECT ovt FROM t{i}))")
    return f"WITH {', '.join(parts)} SELECT osm, ovt, round(score, 6) AS score FROM (" + " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(n)) + ")"


@query(_rounds(8))
def d6_one_to_one_match(spark: SparkSession, d: str) -> DataFrame:
    return _matched(spark, d).select("osm", "ovt", F.round("score", 6).alias("score"))


@query(f"""WITH RECURSIVE t AS MATERIALIZED ({TWINS}), e AS MATERIALIZED (SELECT osm AS u, other AS v FROM t UNION ALL SELECT other, osm FROM t),
 r(n, c) AS (SELECT osm, osm FROM ({DENSE}) UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.n), m AS (SELECT n AS osm, min(c) AS component FROM r GROUP BY n)
 SELECT osm, component, rank, first_value(osm) OVER (PARTITION BY component ORDER BY rank) AS winner FROM (SELECT osm, component, row_number() OVER (PARTITION BY component ORDER BY bal DESC, (name IS NOT NULL)::INT DESC, osm) AS rank FROM m JOIN ({DENSE}) USING (osm))""")
def d8_d10_self_dedup(spark: SparkSession, d: str) -> DataFrame:
    return conflate.winners(_twins(spark, d), "component", "osm", "bal", ["name1"]).select("osm", "component", "rank", "winner")


def _twins(spark: SparkSession, d: str) -> DataFrame:
    rows = _dense(spark, d).withColumns({"radius": (60 + F.col("kind") * 20).cast("double"), "label": F.col("kind").cast("string"), "bits": F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), (F.col("kind") % 3 + 1).cast("int"))})
    return rows.join(conflate.self_components(spark, rows, "osm", "name1", "label", "bits", "radius"), "osm")


@query(f"""WITH RECURSIVE t AS MATERIALIZED ({TWINS}), e AS MATERIALIZED (SELECT osm AS u, other AS v FROM t UNION ALL SELECT other, osm FROM t), r(n, c) AS (SELECT osm, osm FROM ({DENSE}) UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.n),
 m AS (SELECT n AS osm, min(c) AS component FROM r GROUP BY n), w AS (SELECT osm, component, bal, row_number() OVER (PARTITION BY component ORDER BY bal DESC, (name IS NOT NULL)::INT DESC, osm) AS rank FROM m JOIN ({DENSE}) USING (osm))
 SELECT a.osm AS dropped, a.component, b.osm AS winner, round(a.bal, 6) AS confidence, round(b.bal, 6) AS winner_confidence FROM w a JOIN w b ON a.component = b.component AND a.rank > 1 AND b.rank = 1""")
def d11_dedup_audit(spark: SparkSession, d: str) -> DataFrame:
    ranked = conflate.winners(_twins(spark, d), "component", "osm", "bal", ["name1"])
    return conflate.audit(ranked, "osm", "component", "bal").select(F.col("osm").alias("dropped"), "component", "winner", F.round("confidence", 6).alias("confidence"), F.round("winner_confidence", 6).alias("winner_confidence"))


@query(f"""WITH m AS ({_rounds(8)}), o AS (SELECT osm, (bal + 1000) / 12000 AS c FROM ({L})), v AS (SELECT ovt, least(price / 2100, 1) AS c FROM ({R}))
 SELECT 'matched' AS source, m.osm, m.ovt, round((o.c + 0.7 * v.c) / 1.7, 10) AS conf FROM m JOIN o USING (osm) JOIN v USING (ovt)
 UNION ALL SELECT 'osm', osm, NULL, round(c, 10) FROM o WHERE osm NOT IN (SELECT osm FROM m) UNION ALL SELECT 'overture', NULL, ovt, round(c * 0.7, 10) FROM v WHERE ovt NOT IN (SELECT ovt FROM m)""")
def d12_three_way_merge(spark: SparkSession, d: str) -> DataFrame:
    o = _left(spark, d).select("osm", ((F.col("bal") + 1000) / 12000).alias("co"))
    v = _right(spark, d).select("ovt", F.least(F.col("price") / 2100, F.lit(1.0)).alias("cv"))
    m = _matched(spark, d).select("osm", "ovt")
    none = F.lit(None).cast("long")
    row = lambda source, osm, ovt, conf: (lambda df: df.select(F.lit(source).alias("source"), osm, ovt, F.round(conf, 10).alias("conf")))
    return conflate.merge(o, v, m, "osm", "ovt", row("matched", F.col("osm"), F.col("ovt"), numeric.blend_confidence(F.col("co"), F.col("cv"))), row("osm", F.col("osm"), none.alias("ovt"), F.col("co")), row("overture", none.alias("osm"), F.col("ovt"), F.col("cv") * 0.7))


SQUARE = [[-122.44, 47.51], [-122.30, 47.51], [-122.30, 47.60], [-122.44, 47.60]]


@query(f"SELECT osm, coalesce(CASE WHEN lon > -122.44 AND lon < -122.30 AND lat > 47.51 AND lat < 47.60 AND NOT (lon >= -122.40 AND lon <= -122.35 AND lat >= 47.53 AND lat <= 47.55) THEN 'msa' END, 'NO_MSA') AS msa FROM ({L})")
def j7_point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    hole = [[-122.40, 47.53], [-122.35, 47.53], [-122.35, 47.55], [-122.40, 47.55]]
    areas = spark.createDataFrame([("msa", [SQUARE, hole])], "msa string, rings array<array<array<double>>>")
    return spatial.polygon_join(_left(spark, d).select("osm", "lon", "lat"), areas, "osm", "msa").select("osm", F.coalesce("msa", F.lit("NO_MSA")).alias("msa"))


EVENTS = "SELECT *, event_type = 'signup' AS a, event_type = 'error' AS x, event_type = 'view' AS c, event_type = 'click' AS r FROM events"


@query(f"""WITH g AS (SELECT *, max(a::INT) OVER w AS gate, last_value(CASE WHEN a THEN round(value, 2)::VARCHAR END IGNORE NULLS) OVER w AS held FROM ({EVENTS}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
 k AS (SELECT *, CASE WHEN a THEN 1 WHEN x OR c THEN 2 WHEN r THEN 3 END AS ev, CASE WHEN a OR r THEN held END AS v, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_at FROM g WHERE gate = 1),
 n AS (SELECT *, count(ev) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM k)
 SELECT event_id, first_value(v) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id) AS tag_value, (ev IS NOT NULL)::INT AS changed, last_at FROM n""")
def d14_observations(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.round("value", 2).cast("string").alias("value"), *[(F.col("event_type") == t).alias(c) for t, c in (("signup", "added"), ("error", "deleted"), ("view", "closed"), ("click", "reopened"))])
    return history.observations(e, "user_id", ["ts", "event_id"], "ts").select("event_id", "tag_value", "changed", "last_at")


@query("""SELECT event_id, event_type, prior FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'hard_delete' WHEN 'view' THEN 'lifecycle_prefix_added' WHEN 'click' THEN 'primary_tag_deleted' WHEN 'purchase' THEN 'substantial_rename' END AS event_type,
 last_value(CASE WHEN event_type = 'signup' THEN round(value, 2)::VARCHAR END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM events) WHERE event_type IS NOT NULL AND prior IS NOT NULL""")
def d15_ghosts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    own = F.when(F.col("event_type") == "signup", F.round("value", 2).cast("string"))
    v = e.select("event_id", "user_id", "ts", (F.col("event_type") != "error").alias("visible"), (F.col("event_type") == "view").alias("prefix_added"), (F.col("event_type") == "click").alias("primary_deleted"), (F.col("event_type") == "purchase").alias("renamed"), own.alias("name"), own.alias("lat"), own.alias("lon"))
    return history.ghosts(v, "user_id", ["ts", "event_id"]).select("event_id", "event_type", F.col("prior_name").alias("prior"))


@query("""WITH b AS (SELECT user_id AS id, event_id AS version FROM events WHERE event_type IN ('signup', 'view')), w AS (SELECT user_id AS id, event_id AS version FROM events), k AS (SELECT id, max(version) AS m FROM b GROUP BY id)
 SELECT * FROM b UNION ALL SELECT w.id, w.version FROM w LEFT JOIN k ON w.id = k.id WHERE m IS NULL OR w.version > m""")
def d18_roll_forward(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    told = lambda df: df.select(F.col("user_id").alias("id"), F.col("event_id").alias("version"))
    return history.roll_forward(told(e.where("event_type IN ('signup', 'view')")), told(e).unionByName(told(e.where("event_type = 'click'"))), ["id"])


@query("""WITH d AS (SELECT l_returnflag AS state, day, sum(x) AS x FROM (SELECT l_returnflag, l_shipdate::DATE AS day, 1 AS x FROM lineitem UNION ALL SELECT l_returnflag, (l_shipdate + INTERVAL 1 DAY * l_quantity::INT)::DATE, -1 FROM lineitem) GROUP BY 1, 2)
 SELECT state, strftime(day, '%Y-%m-%d') AS day, sum(x) OVER (PARTITION BY state ORDER BY day)::BIGINT AS n FROM d""")
def a24_step_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("state"), F.to_date("l_shipdate").alias("s"), F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("e"))
    return history.step_counts(rows, "s", "e", "state").withColumn("day", F.col("day").cast("string"))


CROSSWALK = [("p_brand", "Brand#11", "EXCLUDE"), ("p_brand", "Brand#12", "Cafe"), ("p_type", "PROMO", "Market"), ("p_type", "*", "Other Place"), ("p_brand", "Brand#12", "Late")]


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#12' THEN 'Cafe' WHEN p_type = 'PROMO' THEN 'Market' WHEN p_type IS NOT NULL THEN 'Other Place' END AS label FROM part")
def j10_value_cascade(spark: SparkSession, d: str) -> DataFrame:
    cross = spark.createDataFrame([(*x, i) for i, x in enumerate(CROSSWALK)], "key string, value string, label string, line int")
    return lookup.value_cascade(table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), cross, ["p_brand", "p_type"]).select("p_partkey", "label")


@query("""SELECT c_custkey, CASE WHEN r = 'ASIA' AND c_mktsegment = 'BUILDING' THEN 'A' WHEN c_mktsegment = 'MACHINERY' THEN 'B' WHEN r = 'EUROPE' THEN 'C' END AS label,
 CASE WHEN r = 'ASIA' AND c_mktsegment = 'BUILDING' THEN 1 WHEN c_mktsegment = 'MACHINERY' THEN 2 WHEN r = 'EUROPE' THEN 3 END AS tier
 FROM (SELECT c_custkey, c_mktsegment, r_name AS r FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""")
def j11_j12_d25_tier_lookup(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("r_name").alias("r"), F.col("c_mktsegment").alias("s"))
    look = spark.createDataFrame([("ASIA", "BUILDING", "A"), ("", "MACHINERY", "B"), ("EUROPE", "", "C")], "r string, s string, v string")
    return lookup.tier_lookup(rows, look, [["r", "s"], ["s"], ["r"]], ["r", "s"], "v").select("c_custkey", "label", "tier")


@query("""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^\\s*https?://', ''), '^www\\.', ''), '\\?.*$', ''), '#.*$', ''), '/+$', '') AS site,
 CASE WHEN length(regexp_replace(url || page_id::VARCHAR || '5550001234', '\\D', '', 'g')) >= 10 THEN right(regexp_replace(url || page_id::VARCHAR || '5550001234', '\\D', '', 'g'), 10) ELSE '' END AS phone FROM pages""")
def fs8_fs10_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.website("url").alias("site"), text.phone(F.concat("url", F.col("page_id").cast("string"), F.lit("5550001234"))).alias("phone"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS name, 'osm:' || left(lower(p_brand), 1) || p_partkey::VARCHAR AS key, trim(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS market FROM part")
def fs1_fs12_fs13_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.matcher_name("p_name").alias("name"), text.osm_key("p_brand", "p_partkey").alias("key"), text.market_name("p_name").alias("market"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, floor((epoch_us(TIMESTAMP '1999-01-01') - epoch_us(l_shipdate)) / 86400000000)::BIGINT AS days, least(100, greatest(0, round_even((epoch_us(TIMESTAMP '1999-01-01') - epoch_us(l_shipdate)) / (365.25 * 86400000000.0) * 10, 0)))::INT AS tenths FROM lineitem")
def fd1_fd2_dates(spark: SparkSession, d: str) -> DataFrame:
    now = F.lit("1999-01-01").cast("timestamp")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", numeric.days(F.col("l_shipdate"), now).alias("days"), numeric.years_tenths(F.col("l_shipdate"), now).alias("tenths"))


@query("""SELECT p_partkey, round(CASE WHEN x <= 0.1 THEN 0.05 WHEN x <= 0.5 THEN 0.05 + (x - 0.1) * ((0.6 - 0.05) / (0.5 - 0.1)) WHEN x <= 0.9 THEN 0.6 + (x - 0.5) * ((0.95 - 0.6) / (0.9 - 0.5)) ELSE 0.95 END, 8) AS conf,
 CASE WHEN x < 0.25 THEN 0.1 WHEN x < 0.5 THEN 0.4 WHEN x < 0.75 THEN 0.6 ELSE 0.9 END AS stepped FROM (SELECT p_partkey, p_size / 50.0::DOUBLE AS x FROM part)""")
def d22_calibration(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("p_size") / 50.0
    return table(spark, d, "part").select("p_partkey", F.round(numeric.interpolate(x, [0.1, 0.5, 0.9], [0.05, 0.6, 0.95]), 8).alias("conf"), numeric.step(x, [0.0, 0.25, 0.5, 0.75, 1.0], [0.1, 0.4, 0.6, 0.9]).alias("stepped"))


@query("""SELECT c_custkey, round(CASE WHEN c_custkey % 7 = 0 THEN c * CASE c_mktsegment WHEN 'BUILDING' THEN 0.5 ELSE 0.141 END ELSE c END, 13) AS conf_mean, round(CASE WHEN c_custkey % 7 <> 0 THEN c * 0.9 END, 13) AS conf_lower, c_custkey % 7 = 0 AS demoted
 FROM (SELECT c_custkey, c_mktsegment, (c_acctbal + 1000) / 12000 AS c FROM customer)""")
def d17_demotion(spark: SparkSession, d: str) -> DataFrame:
    c = (F.col("c_acctbal") + 1000) / 12000
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment", c.alias("conf_mean"), (c * 0.9).alias("conf_lower"), (c * 1.1).alias("conf_upper"))
    deltas = spark.createDataFrame([("BUILDING", 0.5)], "c_mktsegment string, delta double")
    out = conflate.demote(rows, rows.where("c_custkey % 7 = 0"), "c_custkey", deltas, "c_mktsegment")
    return out.select("c_custkey", F.round("conf_mean", 13).alias("conf_mean"), F.round("conf_lower", 13).alias("conf_lower"), "demoted")


@query("SELECT s_suppkey, CASE WHEN s_suppkey = 3 OR s_nationkey = 4 THEN 0.0 WHEN s_suppkey IN (5, 3) THEN 1.0 ELSE s_acctbal END AS conf_mean, s_suppkey IN (3, 5) OR s_nationkey = 4 AS pinned FROM supplier")
def j15_d23_pins(spark: SparkSession, d: str) -> DataFrame:
    pins = spark.createDataFrame([(3, None, "exclude"), (3, None, "include"), (5, None, "include"), (None, 4, "exclude")], "s_suppkey long, s_nationkey int, action string")
    rows = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.col("s_acctbal").alias("conf_mean"))
    return conflate.pin(rows, pins, ["s_suppkey", "s_nationkey"]).select("s_suppkey", "conf_mean", "pinned")


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(1 - exp(-(0.2 * least(b, 1.5) + 0.05 * greatest(b - 1.5, 0) - 0.2 * least(a, 1.5) - 0.05 * greatest(a - 1.5, 0))), 8) AS broken, round(1 - 0.9 * exp(-((b / 6) ** 1.2 - (a / 6) ** 1.2)), 8) AS weibull, round(1 - exp(-(0.8 * ln(1 + b / 4) - 0.8 * ln(1 + a / 4))), 8) AS lomax FROM (SELECT *, l_quantity / 25 AS a, l_quantity / 10 AS b FROM lineitem)")
def d28_m2_hazards(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("l_quantity") / 25, F.col("l_quantity") / 10
    p = numeric.changed_between
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(p("breakpoint", a, b, {"rate1": 0.2, "rate2": 0.05, "at": 1.5}), 8).alias("broken"), F.round(p("weibull", a, b, {"shape": 1.2, "scale": 6.0}, 0.1), 8).alias("weibull"), F.round(p("lomax", a, b, {"shape": 0.8, "scale": 4.0}), 8).alias("lomax"))


@query("""WITH r AS (SELECT o_orderkey AS rid, CASE WHEN o_orderpriority = '1-URGENT' THEN ['a' || (o_orderkey // 2)::VARCHAR] ELSE ['b' || o_orderkey::VARCHAR] END AS keys FROM orders),
 g AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'a' ELSE 'b' END || o_orderkey::VARCHAR AS source_key, 'u' || o_orderkey::VARCHAR AS unified_id, o_orderkey AS minted FROM orders),
 e AS (SELECT rid, unified_id, minted FROM (SELECT rid, unnest(keys) AS k FROM r) JOIN g ON k = source_key),
 t AS (SELECT rid, unified_id FROM (SELECT *, row_number() OVER (PARTITION BY unified_id ORDER BY rid) AS n FROM e) WHERE n = 1)
 SELECT r.rid, coalesce(t.unified_id, md5(r.rid::VARCHAR)) AS unified_id, t.unified_id IS NOT NULL AS carried FROM r LEFT JOIN t ON r.rid = t.rid""")
def d20_stable_ids(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "rid")
    own, half = F.col("rid").cast("string"), F.floor(F.col("rid") / 2).cast("string")
    key = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("a"), half)).otherwise(F.concat(F.lit("b"), own))
    reg = o.select(F.concat(F.when(F.col("o_orderstatus") == "F", "a").otherwise("b"), own).alias("source_key"), F.concat(F.lit("u"), own).alias("unified_id"), F.format_string("%015d", "rid").alias("id_minted"), F.lit("r1").alias("last_release"))
    ids, _ = conflate.stable_ids(spark, o.select("rid", F.array(key).alias("keys")), reg, F.md5(F.col("rid").cast("string")))
    return ids


@query("""SELECT 'u' || (k - 3)::VARCHAR AS old_id, md5(k::VARCHAR) AS new_id, 'split_from' AS change FROM (SELECT o_orderkey AS k FROM orders) WHERE k % 6 = 5
 UNION ALL SELECT 'm' || o_orderkey::VARCHAR, 'u' || o_orderkey::VARCHAR, 'merged_into' FROM orders WHERE o_orderkey % 6 = 0 UNION ALL SELECT NULL, md5(o_orderkey::VARCHAR), 'minted' FROM orders WHERE o_orderkey % 6 = 1
 UNION ALL SELECT 'r' || o_orderkey::VARCHAR, NULL, 'retired' FROM orders WHERE o_orderkey % 6 = 1 UNION ALL SELECT 'u' || o_orderkey::VARCHAR, 'u' || o_orderkey::VARCHAR, 'revived' FROM orders WHERE o_orderkey % 6 = 3
 UNION ALL SELECT 'u' || o_orderkey::VARCHAR, md5(o_orderkey::VARCHAR), 'renamed_guard' FROM orders WHERE o_orderkey % 6 = 4 UNION ALL SELECT 'u' || o_orderkey::VARCHAR, NULL, 'retired' FROM orders WHERE o_orderkey % 6 = 4""")
def d20_changes(spark: SparkSession, d: str) -> DataFrame:
    """Keys by class: 0 merges two ids, 1 is new beside an id that goes, 2 and 5 split one, 3 is back, 4 has another name."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("rid"))
    k, own = F.col("rid") % 6, F.col("rid").cast("string")
    a, more = F.concat(F.lit("a"), own), F.when(k == 0, F.concat(F.lit("y"), own)).when(k == 5, F.concat(F.lit("a"), (F.col("rid") - 3).cast("string")))
    release = o.select("rid", F.array_compact(F.array(a, more)).alias("keys"), F.when(k == 4, "zinc quay").otherwise("alpha shop").alias("name"))
    row = lambda at, key, id_: o.where(at).select(F.concat(F.lit(key), own).alias("source_key"), F.concat(F.lit(id_), own).alias("unified_id"), F.lit("r0" if id_ == "u" else "r1").alias("id_minted"), F.lit("r1").alias("last_release"), (k == 3).alias("retired"), F.lit("alpha shop").alias("name"))
    registry = row(k.isin(0, 2, 3, 4), "a", "u").unionByName(row(k == 0, "y", "m")).unionByName(row(k == 1, "x", "r"))
    return conflate.stable_ids(spark, release, registry, lambda salt: F.md5(own if not salt else F.concat(own, F.lit(f"#{salt}"))), guard=70.0)[1]


@query("""WITH b AS (SELECT user_id AS id, max(event_id) AS known, arg_max(event_type <> 'error', event_id) AS live FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1), w AS (SELECT user_id AS id, event_id, event_id AS version, ts, event_type = 'error' AS deleted FROM events WHERE ts >= TIMESTAMP '2024-01-07'),
 r AS (SELECT w.*, greatest(coalesce(known, 0), coalesce(max(CASE WHEN NOT deleted THEN version END) OVER (PARTITION BY w.id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS before, coalesce(lag(deleted) OVER (PARTITION BY w.id ORDER BY event_id), NOT coalesce(live, true)) AS was FROM w LEFT JOIN b ON w.id = b.id)
 SELECT id, CASE WHEN deleted THEN before + 1 ELSE version END AS version, CASE WHEN deleted THEN (ts::DATE + INTERVAL 1 DAY)::TIMESTAMP ELSE ts END AS at, NOT deleted AS visible FROM r WHERE (deleted AND NOT was) OR (NOT deleted AND version > before)""")
def d18_replay(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    kind = e.schema["ts"].dataType
    told = e.select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_id").alias("version"), F.col("ts").alias("at"), F.date_add(F.to_date("ts"), 1).cast(kind).alias("cut"), (F.col("event_type") == "error").alias("deleted"))
    base = told.where(F.col("at") < F.lit("2024-01-08").cast(kind)).select("id", "version", (~F.col("deleted")).alias("visible"))
    return history.replay(base, told.where(F.col("at") >= F.lit("2024-01-07").cast(kind)), "id", "seq").select("id", "version", "at", "visible")


@query()
def fs2_fs7_names_match(spark: SparkSession, d: str) -> DataFrame:
    """Names next to each other in order of key, on distinct pairs."""
    n = table(spark, d, "part").select("p_partkey", "p_name")
    pairs = n.alias("a").join(n.alias("b"), F.expr("b.p_partkey = a.p_partkey + 1")).select(F.col("a.p_name").alias("a"), F.col("b.p_name").alias("b")).distinct()
    return pairs.select("a", "b", fuzzy.plain_name_udf("a").alias("plain"), fuzzy.set_ratio_udf("a", "b").alias("set_ratio"), fuzzy.sort_ratio_udf("a", "b").alias("sort_ratio"), fuzzy.same_name_udf("a", "b").alias("same"))


@query()
def fi1_fg4_ids_and_geohash(spark: SparkSession, d: str) -> DataFrame:
    left = _left(spark, d)
    return left.select("osm", fuzzy.mint_udf(text.ovt_key(F.col("osm").cast("string"))).alias("unified_id"), numeric.geohash(F.col("lon"), F.col("lat")).alias("geohash"))
