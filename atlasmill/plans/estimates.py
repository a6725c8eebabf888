"""Cells, running sums, geometry and score functions, on stand-ins derived from the driver's tables."""

from __future__ import annotations

import math
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions import geometry, numeric
from atlasmill.operators import cells
from atlasmill.plans.domain import L, _left
from atlasmill.plans.registry import query
from atlasmill.session import table


@query("""SELECT l_returnflag, l_linestatus, round(sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END), 4) AS dt_first, round(sum(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity END), 4) AS dt_later, count(*) FILTER (WHERE l_linenumber = 1) AS n_first,
 (SELECT count(*) FROM lineitem WHERE l_discount > 0.05) AS n_changed FROM lineitem WHERE NOT (l_discount > 0.05) GROUP BY 1, 2""")
def a16_sufficient_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", (F.col("l_linenumber") == 1).alias("first"), (F.col("l_discount") > 0.05).alias("changed"))
    stats, changed = cells.sufficient_stats(rows, ["l_returnflag", "l_linestatus"], "l_quantity", "first", "changed")
    return stats.withColumns({c: F.round(c, 4) for c in ("dt_first", "dt_later")}).join(changed.agg(F.count("*").alias("n_changed")))


@query("SELECT c_mktsegment, c_nationkey, count(DISTINCT o_orderpriority || o_orderstatus) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 HAVING count(DISTINCT o_orderpriority || o_orderstatus) >= 15")
def a17_active_cells(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "c_nationkey", F.concat("o_orderpriority", "o_orderstatus").alias("k"))
    return cells.active_cells(rows, ["c_mktsegment", "c_nationkey"], "k", 15)


@query()
def a19_merged_bins(spark: SparkSession, d: str) -> DataFrame:
    """Discounts are atoms, most of them, and quantities aren't: both columns' bins. Which bins meet is a loop that SQL has no plain form for."""
    rows = table(spark, d, "lineitem").select((F.col("l_discount") * 1.0).alias("a"), (F.col("l_extendedprice") / 1e6).alias("b"))
    return cells.binned(rows, "a", 10, 2500).withColumn("axis", F.lit("a")).unionByName(cells.binned(rows, "b", 20, 2500, 3).withColumn("axis", F.lit("b")))


@query("""SELECT i, j, round(least(1, greatest(0, avg(q) + coalesce(sum(CASE WHEN y IS NOT NULL AND w > 0 THEN w * (y - q) END), 0) / count(*))), 8) AS estimate, count(*) AS n, count(y) AS n_seen
 FROM (SELECT c_nationkey % 4 AS i, (c_custkey % 3)::BIGINT AS j, (c_acctbal + 1000) / 12000 AS q, CASE WHEN c_custkey % 5 = 0 THEN (c_custkey % 10 = 0)::INT END AS y, CASE WHEN c_nationkey % 4 = 2 THEN 0 ELSE 5 END AS w FROM customer) GROUP BY 1, 2""")
def a20_difference_estimate(spark: SparkSession, d: str) -> DataFrame:
    y = F.when(F.col("c_custkey") % 5 == 0, (F.col("c_custkey") % 10 == 0).cast("int"))
    rows = table(spark, d, "customer").select((F.col("c_nationkey") % 4).alias("i"), (F.col("c_custkey") % 3).alias("j"), ((F.col("c_acctbal") + 1000) / 12000).alias("q"), y.alias("y"), F.when(F.col("c_nationkey") % 4 == 2, 0).otherwise(5).alias("w"))
    return cells.difference_estimate(rows, ["i", "j"], "q", "y", "w").withColumn("estimate", F.round("estimate", 8))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS id FROM orders")
def w3_dense_ids(spark: SparkSession, d: str) -> DataFrame:
    return cells.dense_ids(spark, table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


@query("""WITH n AS (SELECT user_id, count(*) AS n, md5(user_id::VARCHAR) AS h FROM events GROUP BY 1), r AS (SELECT *, sum(n) OVER (ORDER BY h, user_id) AS s FROM n)
 SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM r WHERE s <= 700 OR s = n)""")
def w18_budget(spark: SparkSession, d: str) -> DataFrame:
    return cells.budget(spark, table(spark, d, "events").select("event_id", "user_id"), "user_id", 700).select("event_id")


@query("""WITH t AS (SELECT *, event_type IN ('click', 'error') AS touched, CASE WHEN event_type = 'click' THEN value END AS v FROM events),
 g AS (SELECT *, sum(touched::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM t), l AS (SELECT user_id, k, v FROM g WHERE touched)
 SELECT g.event_id, l.v AS current, b.v AS last FROM g LEFT JOIN l ON g.user_id = l.user_id AND g.k = l.k LEFT JOIN l b ON g.user_id = b.user_id AND b.k = g.k - g.touched::INT""")
def w11_carried(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", F.when(F.col("event_type") == "click", F.col("value")).alias("v"))
    return cells.carried(rows, "user_id", ["ts", "event_id"], F.col("event_type").isin("click", "error"), "v", "current", "last").select("event_id", "current", "last")


@query("SELECT event_id, event_id = max(event_id) OVER (PARTITION BY user_id, event_type) AS newest FROM events")
def w13_w14_newest(spark: SparkSession, d: str) -> DataFrame:
    return cells.newest(table(spark, d, "events"), ["user_id", "event_type"], "event_id").select("event_id", "newest")


def _wkb(lon, lat):
    """A point in little-endian well-known binary, for a test table."""
    return bytes([1]) + struct.pack("<Idd", 1, lon, lat)


def _square(lon, lat, half):
    ring = [(lon - half, lat - half), (lon + half, lat - half), (lon + half, lat + half), (lon - half, lat + half), (lon - half, lat - half)]
    return bytes([1]) + struct.pack("<III", 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring)


@query("""SELECT n_nationkey::BIGINT AS id, round(n_nationkey * 1.5 - 20, 8)::DOUBLE AS lon, round(n_nationkey * 2.0 - 10, 8)::DOUBLE AS lat, n_nationkey % 2 = 0 AS from_right, round(n_nationkey * 1.5 - 20, 8)::DOUBLE AS inner_lon FROM nation""")
def fg1_fg2_fg5_geometry(spark: SparkSession, d: str) -> DataFrame:
    """Squares on the right where the key is even, else points on both sides."""
    n = [r[0] for r in table(spark, d, "nation").select("n_nationkey").collect()]  # a fixed table of 25 rows
    at = [(k * 1.5 - 20, k * 2.0 - 10) for k in n]
    rows = [(int(k), bytearray(_wkb(x, y)), bytearray(_square(x, y, 0.5) if k % 2 == 0 else _wkb(x + 1, y))) for k, (x, y) in zip(n, at, strict=True)]
    df = spark.createDataFrame(rows, "id long, a binary, b binary").withColumn("g", geometry.pick_geometry(F.col("a"), F.col("b")))
    df = df.select("id", geometry.centroid("g").alias("c"), (F.col("g") != F.col("a")).alias("from_right"), geometry.representative("g").alias("r"))
    return df.select("id", F.round("c.lon", 8).alias("lon"), F.round("c.lat", 8).alias("lat"), "from_right", F.round("r.lon", 8).alias("inner_lon"))


DEGREE = 6_371_000.0 * math.pi / 180


@query(f"""SELECT kind, round((x1 - x0) * {DEGREE!r} * c, 4) AS width, round((y1 - y0) * {DEGREE!r}, 4) AS height, round(200 / {DEGREE!r} / c, 10) AS dx, round(200 / {DEGREE!r}, 10) AS dy
 FROM (SELECT *, greatest(cos(radians((y0 + y1) / 2)), 0.01) AS c FROM (SELECT kind, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM ({L}) GROUP BY kind))""")
def fg6_halo(spark: SparkSession, d: str) -> DataFrame:
    box = _left(spark, d).groupBy("kind").agg(F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1"))
    w, h, dx, dy = geometry.halo(*[F.col(c) for c in ("x0", "y0", "x1", "y1")], 200.0)
    return box.select("kind", F.round(w, 4).alias("width"), F.round(h, 4).alias("height"), F.round(dx, 10).alias("dx"), F.round(dy, 10).alias("dy"))


LOGITS = "(SELECT p_partkey, ln(x / (1 - x)) AS a, ln(y / (1 - y)) AS b FROM (SELECT p_partkey, least(0.9999, greatest(0.0001, p_size / 50.0::DOUBLE)) AS x, least(0.9999, greatest(0.0001, p_retailprice / 2100)) AS y FROM part))"


@query(f"SELECT p_partkey, round(1 / (1 + exp(-(0.1 + 0.6 * a + 0.5 * b))), 10) AS pooled, round(1 / (1 + exp(-(0.1 + 0.6 * a + 0.5 * b - 0.05 * a * b))), 10) AS crossed, round(a, 10) AS logit FROM {LOGITS}")
def fm1_fm2_two_scores(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("p_size") / 50.0, F.col("p_retailprice") / 2100
    return table(spark, d, "part").select("p_partkey", F.round(geometry.pooled(a, b, (0.1, 0.6, 0.5)), 10).alias("pooled"), F.round(geometry.interacting(a, b, (0.1, 0.6, 0.5, -0.05)), 10).alias("crossed"), F.round(numeric.logit(a), 10).alias("logit"))


@query("""WITH p AS (SELECT DISTINCT p_brand || '/' || p_type AS leaf, left(p_brand, 7) AS l0, p_brand AS l1, p_brand || '/' || p_type AS l2 FROM part), c AS (SELECT p_brand || '/' || p_type AS leaf, count(*) AS n FROM part GROUP BY 1), t AS (SELECT sum(n) AS t FROM c),
 i0 AS (SELECT l0, -ln(sum(n) / (SELECT t FROM t)) AS ic FROM p JOIN c USING (leaf) GROUP BY 1), i1 AS (SELECT l0, l1, -ln(sum(n) / (SELECT t FROM t)) AS ic FROM p JOIN c USING (leaf) GROUP BY 1, 2), i2 AS (SELECT leaf, -ln(n / (SELECT t FROM t)) AS ic FROM c),
 s AS (SELECT a.leaf AS a, b.leaf AS b, CASE WHEN a.l1 = b.l1 THEN i1.ic ELSE i0.ic END AS lca, x.ic AS ia, y.ic AS ib FROM p a JOIN p b ON a.l0 = b.l0 AND a.leaf < b.leaf JOIN i0 ON i0.l0 = a.l0 JOIN i1 ON i1.l1 = a.l1 JOIN i2 x ON x.leaf = a.leaf JOIN i2 y ON y.leaf = b.leaf)
 SELECT a, b, round(2 * lca / (ia + ib), 8) AS lin, nullif(round(greatest((length(a) * 0.5 + 100 * (2 * lca / (ia + ib))) / (length(a) + 100), 2 * lca / (ia + ib)), 4), 0) AS affinity FROM s""")
def fm3_fm4_affinity(spark: SparkSession, d: str) -> DataFrame:
    leaf = F.concat_ws("/", "p_brand", "p_type")
    part = table(spark, d, "part").select(leaf.alias("leaf"), F.array(F.left("p_brand", F.lit(7)), F.col("p_brand"), leaf).alias("path"))
    lin = cells.lin_similarity(part.distinct(), part.groupBy("leaf").agg(F.count("*").alias("n")))
    return lin.select("a", "b", F.round("lin", 8).alias("lin"), geometry.shrunk_affinity(F.length("a"), F.lit(0.5), F.col("lin")).alias("affinity"))


@query("""SELECT p_partkey, round(least(1, greatest(0, x)) * 20)::INT AS level, CASE WHEN x <= 0 THEN '#000000' WHEN x >= 1 THEN '#ff0080' ELSE '#' || printf('%02x', round(least(1, greatest(0, x)) * 255)::INT) || '00' || printf('%02x', round(least(1, greatest(0, x)) * 128)::INT) END AS colour, round(log2(156543.03 / (p_size * 10)), 8) AS zoom
 FROM (SELECT *, p_size / 45.0::DOUBLE - 0.05 AS x FROM part)""")
def fm5_display(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("p_size") / 45.0 - 0.05
    return table(spark, d, "part").select("p_partkey", geometry.level(x).alias("level"), geometry.ramp(x, [(0, 0, 0), (255, 0, 128)]).alias("colour"), F.round(geometry.zoom(F.col("p_size") * 10), 8).alias("zoom"))


@query("SELECT p_partkey, (CASE WHEN p_brand <> 'Brand#3' THEN 1 ELSE 0 END + CASE WHEN p_size % 4 <> 0 THEN 4 ELSE 0 END)::BIGINT AS bits, ((CASE WHEN p_brand <> 'Brand#3' THEN 1 ELSE 0 END + CASE WHEN p_size % 4 <> 0 THEN 4 ELSE 0 END) & 5) <> 0 AS meets FROM part")
def fb1_bits(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.nullif("p_brand", F.lit("Brand#3")).alias("brand"), F.when(F.col("p_size") % 4 != 0, F.col("p_type")).otherwise("").alias("kind"))
    bits = geometry.bits_of([("brand", 0), ("kind", 2)])
    return rows.select("p_partkey", bits.alias("bits"), (bits.bitwiseAND(F.lit(5)) != 0).alias("meets"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round((epoch_us(l_shipdate) - epoch_us(o)) / (365 * 86400000000.0), 9) AS age_start, round((epoch_us(TIMESTAMP '2003-01-01') - epoch_us(o)) / (365 * 86400000000.0), 9) AS age_end FROM (SELECT *, CASE WHEN l_linenumber > 2 THEN l_shipdate - INTERVAL 40 DAY ELSE l_shipdate END AS o FROM lineitem)")
def fd3_ages(spark: SparkSession, d: str) -> DataFrame:
    t1 = F.col("l_shipdate").cast("timestamp")
    a, b = geometry.ages(t1, F.lit("2003-01-01").cast("timestamp"), F.when(F.col("l_linenumber") > 2, t1 - F.expr("INTERVAL 40 DAYS")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(a, 9).alias("age_start"), F.round(b, 9).alias("age_end"))
