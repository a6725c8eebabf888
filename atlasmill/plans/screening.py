"""Filters, label joins and viewer predicates, on stand-ins derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions import geometry, text
from atlasmill.operators import cells, filters, spatial
from atlasmill.plans.domain import SQUARE, L, _left
from atlasmill.plans.registry import query
from atlasmill.session import table

PART = "SELECT p_partkey, p_name, nullif(p_brand, 'Brand#3') AS brand, CASE WHEN p_size % 4 <> 0 THEN p_type END AS kind, p_size FROM part"


def _part(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", "p_name", F.nullif("p_brand", F.lit("Brand#3")).alias("brand"), F.when(F.col("p_size") % 4 != 0, F.col("p_type")).alias("kind"), "p_size")


@query("""SELECT p_partkey, h[1] AS l0, h[2] AS l1, h[3] AS l2, h[4] AS l3, nullif(h[1], 'small') AS first FROM (SELECT p_partkey, string_split(p_name, ' ') AS h FROM part)""")
def p1_fn2_projection(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.struct(F.split("p_name", " ").alias("hierarchy")).alias("taxonomy"))
    h = F.col("taxonomy.hierarchy")
    emptied = F.transform(h, lambda x: F.when(x == "small", "").otherwise(x))
    return rows.select("p_partkey", *[F.get(h, F.lit(i)).alias(f"l{i}") for i in range(4)], geometry.first_of(emptied).alias("first"))


@query(f"SELECT p_partkey FROM ({PART}) WHERE coalesce(brand = 'Brand#1' OR (brand = 'Brand#2' AND kind = 'ECONOMY') OR (brand = 'Brand#4' AND kind = 'PROMO'), false)")
def p3_allowed(spark: SparkSession, d: str) -> DataFrame:
    return _part(spark, d).where(filters.allowed(F.col("brand"), F.col("kind"), [("Brand#1", None), ("Brand#2", "ECONOMY"), ("Brand#4", "PROMO")])).select("p_partkey")


@query(f"SELECT osm FROM ({L}) WHERE lon BETWEEN -122.41 AND -122.37 AND lat BETWEEN 47.53 AND 47.56")
def p4_box(spark: SparkSession, d: str) -> DataFrame:
    return _left(spark, d).where(filters.in_box(F.col("lon"), F.col("lat"), (-122.41, 47.53, -122.37, 47.56))).select("osm")


@query(f"SELECT p_partkey FROM ({PART}) WHERE kind IS NOT NULL OR brand IN ('Brand#5', 'Brand#6')")
def p5_tag_filter(spark: SparkSession, d: str) -> DataFrame:
    entries = F.filter(F.array(F.struct(F.lit("brand").alias("k"), F.col("brand").alias("v")), F.struct(F.lit("kind").alias("k"), F.col("kind").alias("v"))), lambda e: e.v.isNotNull())
    return _part(spark, d).where(filters.tag_match(F.map_from_entries(entries), ["kind"], {"brand": ["Brand#5", "Brand#6"]})).select("p_partkey")


EXCLUSIONS = [("brand", "Brand#5"), ("brand", "Brand#6"), ("kind", "PROMO")]


@query(f"SELECT p_partkey FROM ({PART}) WHERE NOT coalesce(brand IN ('Brand#5', 'Brand#6') OR kind = 'PROMO', false) OR coalesce(brand NOT IN ('Brand#5', 'Brand#6'), false) OR coalesce(kind <> 'PROMO', false)".replace("NOT coalesce(brand IN ('Brand#5', 'Brand#6') OR kind = 'PROMO', false)", "NOT (coalesce(brand IN ('Brand#5', 'Brand#6'), false) OR coalesce(kind = 'PROMO', false))"))
def p7_drop_excluded(spark: SparkSession, d: str) -> DataFrame:
    return filters.drop_excluded(_part(spark, d), EXCLUSIONS, ["brand", "kind"]).select("p_partkey")


@query(f"SELECT p_partkey FROM ({PART}) WHERE NOT ((coalesce(brand IN ('Brand#5', 'Brand#6'), false) OR coalesce(kind = 'PROMO', false)) AND p_size % 3 = 0)")
def p6_drop_excluded_unlabelled(spark: SparkSession, d: str) -> DataFrame:
    rows = _part(spark, d).withColumn("label", F.when(F.col("p_size") % 3 != 0, "Shop"))
    return filters.drop_excluded_unlabelled(rows, EXCLUSIONS, ["brand", "kind"]).select("p_partkey")


@query(f"SELECT p_partkey FROM ({PART}) WHERE kind IS NOT NULL AND kind <> 'PROMO'")
def p11_d13_drop_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = _part(spark, d).withColumn("label", F.when(F.col("kind") == "PROMO", "EXCLUDE").otherwise(F.col("kind")))
    return filters.drop_label(rows, unlabelled=True).select("p_partkey")


INSIDE = "lon > -122.44 AND lon < -122.30 AND lat > 47.51 AND lat < 47.60"


@query(f"SELECT osm FROM ({L}) WHERE NOT (osm % 3 = 0 AND kind IN (1, 2) AND {INSIDE})")
def p9_residential(spark: SparkSession, d: str) -> DataFrame:
    rows = _left(spark, d).withColumns({"name": F.when(F.col("osm") % 3 != 0, "x"), "leisure": F.when(F.col("kind") == 1, "pool").when(F.col("kind") == 3, ""), "shop": F.when(F.col("kind") != 1, F.concat(F.lit("s"), F.col("kind").cast("string")))})
    areas = spark.createDataFrame([("a", [SQUARE])], "area string, rings array<array<array<double>>>")
    return filters.drop_residential(rows, areas, "osm", ["leisure", "shop"], [("leisure", "pool"), ("shop", "s2")]).select("osm")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'N' OR epoch_us(l_shipdate) >= epoch_us(TIMESTAMP '2001-06-01') - (1.5 * 365.25 * 86400000000)::BIGINT")
def p12_recent(spark: SparkSession, d: str) -> DataFrame:
    ts = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate").cast("timestamp"))
    return table(spark, d, "lineitem").where(filters.recent(ts, F.lit("2001-06-01").cast("timestamp"), 1.5)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT p_partkey, p_size / 50.0::DOUBLE AS conf FROM part")
def p13_checked_range(spark: SparkSession, d: str) -> DataFrame:
    return filters.require_range(table(spark, d, "part").select("p_partkey", (F.col("p_size") / 50.0).alias("conf")), "conf")


@query("""WITH r AS (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN event_type END AS g, value / 10 - 1 AS years FROM events), k AS (SELECT * FROM r WHERE user_id IN (SELECT user_id FROM r WHERE g IS NOT NULL) AND g IN ('view', 'click', 'signup'))
 SELECT event_id FROM k WHERE g IN (SELECT g FROM k GROUP BY g HAVING count(*) >= 50) AND years > 1e-6""")
def p14_model_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("g"), (F.col("value") / 10 - 1).alias("years"))
    return filters.model_rows(rows, "user_id", "g", "years", ["view", "click", "signup"], 50).select("event_id")


@query(f"SELECT p_partkey, true AS every, false AS none, coalesce(kind IN ('PROMO', 'ECONOMY'), false) AS some, brand IS NOT NULL OR kind IS NOT NULL AS keyed, coalesce(kind, 'other:' || brand) IS NULL OR coalesce(kind, 'other:' || brand) NOT IN ('PROMO', 'other:Brand#4') AS unhidden FROM ({PART})")
def p15_p17_viewer(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("kind")
    shown = {"every": filters.shown(kind, None), "none": filters.shown(kind, []), "some": filters.shown(kind, ["PROMO", "ECONOMY"]), "keyed": filters.any_key(["brand", "kind"]), "unhidden": filters.not_hidden(kind, F.col("brand"), ["PROMO", "other:Brand#4"])}
    return _part(spark, d).select("p_partkey", *[c.alias(n) for n, c in shown.items()])


@query("""SELECT n.s_suppkey, b.s_acctbal / 10000 AS conf_before, round(n.s_acctbal * 0.8 / 10000 - b.s_acctbal / 10000, 10) AS delta, a.n_name AS name FROM supplier n JOIN supplier b ON n.s_suppkey = b.s_suppkey AND b.s_nationkey <> 3 LEFT JOIN nation a ON n.s_suppkey = a.n_nationkey
 WHERE n.s_suppkey % 2 = 0 AND n.s_suppkey % 3 <> 0 AND n.s_acctbal * 0.8 < b.s_acctbal""")
def p18_j16_demoted(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    now = s.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "overture").otherwise("osm").alias("source"), (F.col("s_suppkey") % 3 != 0).alias("shadow_matched"), (F.col("s_acctbal") * 0.8 / 10000).alias("conf_mean"))
    before = s.where("s_nationkey <> 3").select("s_suppkey", (F.col("s_acctbal") / 10000).alias("conf_mean"))
    audit = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("s_suppkey"), F.col("n_name").alias("name"))
    return filters.demoted(now, before, "s_suppkey", audit).select("s_suppkey", "conf_before", F.round("delta", 10).alias("delta"), "name")


@query(f"SELECT osm FROM ({L}) WHERE {INSIDE}")
def j8_within_boundary(spark: SparkSession, d: str) -> DataFrame:
    boundary = spark.createDataFrame([("b", [SQUARE])], "boundary string, rings array<array<array<double>>>")
    return spatial.polygon_join(_left(spark, d).select("osm", "lon", "lat"), boundary, "osm", "boundary", "inner").select("osm")


@query(f"""SELECT city, count(*) AS n, round(avg(bal), 6) AS bal FROM (SELECT bal, CASE WHEN lon > -122.45 AND lon < -122.40 AND lat > 47.50 AND lat < 47.55 THEN 'west' WHEN lon > -122.40 AND lon < -122.30 AND lat > 47.50 AND lat < 47.60 THEN 'east' END AS city FROM ({L})) WHERE city IS NOT NULL GROUP BY city""")
def j18_in_city(spark: SparkSession, d: str) -> DataFrame:
    box = lambda x0, y0, x1, y1: [[[x0, y0], [x1, y0], [x1, y1], [x0, y1]]]
    cities = spark.createDataFrame([("west", 250_000, box(-122.45, 47.5, -122.40, 47.55)), ("east", 120_000, box(-122.40, 47.5, -122.30, 47.60)), ("north", 90_000, box(-122.45, 47.55, -122.40, 47.70))], "city string, people long, rings array<array<array<double>>>")
    left = _left(spark, d)
    at = spatial.polygon_join(left.select("osm", "lon", "lat"), cities.where("people > 100000"), "osm", "city", "inner")
    return at.join(left.select("osm", "bal"), "osm").groupBy("city").agg(F.count("*").alias("n"), F.round(F.avg("bal"), 6).alias("bal"))


@query("""SELECT p_partkey, array_to_string(CASE WHEN len(own) > 0 THEN own WHEN p_type <> 'PROMO' THEN ['Other Place'] WHEN p_brand <> 'Brand#4' THEN ['Other Brand'] ELSE [] END, '|') AS labels FROM
 (SELECT *, list_distinct(list_filter([CASE p_brand WHEN 'Brand#1' THEN 'Cafe' WHEN 'Brand#2' THEN 'Market' END, CASE p_type WHEN 'STANDARD' THEN 'Market' WHEN 'ECONOMY' THEN 'Hall' END], lambda x: x IS NOT NULL)) AS u,
 CASE WHEN len(u) = 2 THEN list_filter([CASE p_brand WHEN 'Brand#1' THEN 'Cafe' WHEN 'Brand#2' THEN 'Market' END, CASE p_type WHEN 'STANDARD' THEN 'Market' WHEN 'ECONOMY' THEN 'Hall' END], lambda x: x IS NOT NULL) ELSE u END AS own FROM part)""")
def j10b_all_labels(spark: SparkSession, d: str) -> DataFrame:
    lines = [("p_brand", "Brand#1", "Cafe"), ("p_brand", "Brand#2", "Market"), ("p_brand", "Brand#4", "EXCLUDE"), ("p_type", "*", "Other Place"), ("p_type", "STANDARD", "Market"), ("p_type", "ECONOMY", "Hall"), ("p_type", "PROMO", "EXCLUDE"), ("p_brand", "*", "Other Brand"), ("p_brand", "Brand#1", "Late")]
    cross = spark.createDataFrame([(*x, i) for i, x in enumerate(lines)], "key string, value string, label string, line int")
    out = cells.all_labels(table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), cross, ["p_brand", "p_type"])
    return out.select("p_partkey", F.array_join("labels", "|").alias("labels"))


@query("""WITH c AS (SELECT user_id AS id, arg_max(value, event_id) AS lon, arg_max(value * 2, event_id) AS lat FROM events WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY 1), s AS (SELECT c_custkey AS id, c_acctbal AS lon, c_acctbal + 1 AS lat FROM customer WHERE c_nationkey < 5)
 SELECT c_custkey AS id, CASE WHEN s.lon IS NOT NULL THEN s.lon ELSE c.lon END AS lon, CASE WHEN s.lon IS NOT NULL THEN s.lat ELSE c.lat END AS lat FROM customer LEFT JOIN s ON c_custkey = s.id LEFT JOIN c ON c_custkey = c.id""")
def j14_last_known(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    shot = c.where("c_nationkey < 5").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("lon"), (F.col("c_acctbal") + 1).alias("lat"))
    place = F.when(F.col("event_type") != "error", F.col("value"))
    changes = table(spark, d, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("version"), place.alias("lon"), (place * 2).alias("lat"))
    return cells.last_known(c.select(F.col("c_custkey").alias("id")), shot, changes, ["id"])


@query("SELECT c_custkey, c_mktsegment, c_nationkey, CASE WHEN c_nationkey < 12 AND c_mktsegment <> 'BUILDING' THEN c_nationkey / 10.0::DOUBLE ELSE 0.0 END AS w FROM customer")
def j17_weighted(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, d, "nation").where("n_nationkey < 12").select(F.col("n_nationkey").cast("double").alias("c_nationkey"), (F.col("n_nationkey") / 10.0).alias("w"))
    segments = c.where("c_mktsegment <> 'BUILDING'").select("c_mktsegment").distinct()
    return cells.weighted(c, n.join(segments, F.lit(True)), ["c_mktsegment", "c_nationkey"])


@query("SELECT string_agg(s, ',' ORDER BY starts_with(s, 'O'), s) AS labels FROM (SELECT DISTINCT CASE c_mktsegment WHEN 'BUILDING' THEN 'Other Building' ELSE lower(c_mktsegment) END AS s FROM customer)")
def t7_other_last(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("c_mktsegment") == "BUILDING", "Other Building").otherwise(F.lower("c_mktsegment"))
    labels = table(spark, d, "customer").select(label.alias("s")).distinct()
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(F.col("s").startswith("Other ").alias("o"), "s"))), lambda x: x.s)
    return labels.agg(F.array_join(ordered, ",").alias("labels"))


@query("SELECT page_id, regexp_replace(url, '^https?://(www\\.)?|/$', '', 'g') AS bare, try_cast(CASE WHEN page_id % 3 = 0 THEN 'no date' ELSE '2024-01-0' || (page_id % 9 + 1)::VARCHAR || 'T05:00:00Z' END AS TIMESTAMP) AS at FROM pages")
def fs11_fd4_normalised(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("page_id") % 3 == 0, "no date").otherwise(F.concat(F.lit("2024-01-0"), (F.col("page_id") % 9 + 1).cast("string"), F.lit("T05:00:00Z")))
    return table(spark, d, "pages").select("page_id", geometry.bare_url(F.col("url")).alias("bare"), F.try_to_timestamp(raw).cast("timestamp_ntz").alias("at"))


@query("""SELECT p_partkey, regexp_replace(p_name, '_', ' ', 'g') AS plain, 'a' || chr(31) || p_brand AS grp, p_name || ' > ' || p_brand AS path FROM part""")
def fs15_fs16_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.replace("p_name", F.lit("_"), F.lit(" ")).alias("plain"), text.group_key(F.lit("a"), "p_brand").alias("grp"), text.path(F.array("p_name", "p_brand")).alias("path"))
