"""Scans, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.operators.lookup import first_wins, latest, require, wide
from atlasmill.operators import cells
from atlasmill.plans.registry import query
from atlasmill.session import table

def _source() -> Column:
    return F.when(F.col("p_size") % 3 == 0, "matched").when(F.col("p_size") % 3 == 1, "osm").otherwise("overture")



SOURCE_SQL = "CASE p_size % 3 WHEN 0 THEN 'matched' WHEN 1 THEN 'osm' ELSE 'overture' END"


@query("SELECT l_orderkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-02-01' AND l_discount BETWEEN 0.05 AND 0.07")
def s1_scan_projection(spark: SparkSession, d: str) -> DataFrame:
    rows = require(table(spark, d, "lineitem"), ["l_orderkey", "l_quantity", "l_discount", "l_shipdate"])
    return rows.where("l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-02-01' AND l_discount BETWEEN 0.05 AND 0.07").select("l_orderkey", "l_quantity", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


@query("SELECT 'customer' AS source, c_custkey AS k, c_name AS name, c_acctbal AS bal, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT 'part', p_partkey, p_name, NULL, p_brand FROM part")
def s2_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    p = table(spark, d, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return c.unionByName(p, allowMissingColumns=True)


@query(f"""SELECT label, matched, osm, overture, matched + osm + overture AS total, round(100.0 * matched / (matched + osm + overture), 1) AS match_pct FROM (
  SELECT p_type AS label, count(*) FILTER (WHERE s = 'matched') AS matched, count(*) FILTER (WHERE s = 'osm') AS osm, count(*) FILTER (WHERE s = 'overture') AS overture
  FROM (SELECT p_type, {SOURCE_SQL} AS s FROM part) GROUP BY p_type)""")
def a2_label_by_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.col("p_type").alias("label"), _source().alias("source"))
    out = rows.groupBy("label").pivot("source", ["matched", "osm", "overture"]).count().na.fill(0)
    total = F.col("matched") + F.col("osm") + F.col("overture")
    return out.select("label", "matched", "osm", "overture", total.alias("total"), F.round(100.0 * F.col("matched") / total, 1).alias("match_pct"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS disc, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) AS n
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def a1_group_by(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_shipdate <= TIMESTAMP '1998-09-02'")
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(revenue, 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("disc"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.count("*").alias("n"))


@query("SELECT event_type, count(*) FILTER (WHERE value > 50) AS high, count(*) AS n, bool_or(value > 99) AS any_top, count(DISTINCT user_id) AS users FROM events GROUP BY event_type HAVING bool_or(value > 10)")
def a3_a6_conditional(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("high"), F.count("*").alias("n"), F.bool_or(F.col("value") > 99).alias("any_top"), F.count_distinct("user_id").alias("users"), F.bool_or(F.col("value") > 10).alias("some"))
    return out.where("some").drop("some")


KEYS = ["status", "priority", "total"]
EAV_SQL = """SELECT o_custkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version, o_orderstatus, o_orderpriority, o_totalprice FROM orders"""


def _eav(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    v = table(spark, d, "orders").withColumn("version", F.row_number().over(w))
    pairs = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"), F.lit("total"), F.floor("o_totalprice").cast("string"))
    return v.select(F.col("o_custkey").alias("id"), "version", F.explode(pairs).alias("key", "value"))


@query(f"SELECT id, version, o_orderstatus AS status, o_orderpriority AS priority, floor(o_totalprice)::BIGINT::VARCHAR AS total FROM ({EAV_SQL})")
def a4_eav_to_wide(spark: SparkSession, d: str) -> DataFrame:
    return wide(_eav(spark, d), ["id", "version"], "key", "value", KEYS)


@query(f"""SELECT id, key, value, version FROM (SELECT id, version, unnest(['status', 'priority']) AS key, unnest([o_orderstatus, o_orderpriority]) AS value, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS r
  FROM (SELECT *, max(version) OVER (PARTITION BY id) AS m FROM ({EAV_SQL})) WHERE version = m) WHERE value <> 'F'""")
def a5_w2_latest_value(spark: SparkSession, d: str) -> DataFrame:
    return latest(_eav(spark, d).where("key <> 'total'"), ["id", "key"], ["version"], ["value", "version"], F.col("value") != "F")


@query("SELECT c_mktsegment AS seg, min(c_acctbal) AS lo, round(quantile_cont(c_acctbal, 0.25), 4) AS q1, round(median(c_acctbal), 4) AS mid, round(quantile_cont(c_acctbal, 0.75), 4) AS q3, max(c_acctbal) AS hi FROM customer GROUP BY 1")
def a8_quantiles(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("seg"), "c_acctbal")
    out = rows.groupBy("seg").agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi")).join(cells.quantiles(spark, rows, ["seg"], "c_acctbal", [0.25, 0.5, 0.75]), "seg")
    return out.select("seg", "lo", F.round(F.col("q")[0], 4).alias("q1"), F.round(F.col("q")[1], 4).alias("mid"), F.round(F.col("q")[2], 4).alias("q3"), "hi")


@query("SELECT p_brand, round(CASE WHEN sum(w) > 0 THEN sum(w * x) / sum(w) ELSE avg(x) END, 6) AS mean, round(sum(w) * sum(w) / nullif(sum(w * w), 0), 6) AS ess FROM (SELECT p_brand, greatest(p_size - 10, 0)::DOUBLE AS w, p_retailprice AS x FROM part) GROUP BY 1")
def a9_a21_weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_brand", F.greatest(F.col("p_size") - 10, F.lit(0)).cast("double").alias("w"), F.col("p_retailprice").alias("x"))
    sw, swx = F.sum("w"), F.sum(F.col("w") * F.col("x"))
    return rows.groupBy("p_brand").agg(F.round(F.when(sw > 0, swx / sw).otherwise(F.avg("x")), 6).alias("mean"), F.round(sw * sw / F.nullif(F.sum(F.col("w") * F.col("w")), F.lit(0.0)), 6).alias("ess"))


@query("SELECT n_name AS city, CASE WHEN grouping(c_mktsegment) = 1 THEN '__ALL__' ELSE c_mktsegment END AS label, count(*) AS n, round(avg(c_acctbal), 4) AS bal FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_name, c_mktsegment), (n_name))")
def a10_super_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    out = rows.groupingSets([["n_name", "c_mktsegment"], ["n_name"]], "n_name", "c_mktsegment").agg(F.grouping("c_mktsegment").alias("g"), F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("bal"))
    return out.select(F.col("n_name").alias("city"), F.when(F.col("g") == 1, "__ALL__").otherwise(F.col("c_mktsegment")).alias("label"), "n", "bal")


@query("SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), (p_size), (p_brand, p_type, p_size))")
def a11_subgroups(spark: SparkSession, d: str) -> DataFrame:
    keys = ["p_brand", "p_type", "p_size"]
    return table(spark, d, "part").groupingSets([["p_brand"], ["p_type"], ["p_size"], keys], *keys).agg(F.count("*").alias("n"))


RANKED_SQL = "SELECT x, y, avg(rx) OVER (PARTITION BY x) AS ax, avg(ry) OVER (PARTITION BY y) AS ay FROM (SELECT p_size::DOUBLE AS x, p_retailprice AS y, row_number() OVER (ORDER BY p_size) AS rx, row_number() OVER (ORDER BY p_retailprice) AS ry FROM part)"


@query(f"SELECT round(sqrt(avg((x - y) ** 2)), 4) AS rmse, round(avg(abs(x - y)), 4) AS mae, round(avg(x - y), 4) AS bias, round(stddev_pop(x - y), 4) AS sd, round(corr(x, y), 6) AS pearson, round(corr(ax, ay), 6) AS spearman FROM ({RANKED_SQL})")
def a12_w17_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    # mean ranks from counts of distinct values, not of rows
    for v, r in (("x", "ax"), ("y", "ay")):
        n = rows.groupBy(v).agg(F.count("*").alias("n"))
        rank = cells.running_sum(spark, n, [v], F.col("n"), "upto").select(F.col(v), (F.col("upto") - (F.col("n") - 1) / 2).alias(r))
        rows = rows.join(rank, v)
    e = F.col("x") - F.col("y")
    return rows.agg(F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"), F.round(F.avg(F.abs(e)), 4).alias("mae"), F.round(F.avg(e), 4).alias("bias"), F.round(F.stddev_pop(e), 4).alias("sd"), F.round(F.corr("x", "y"), 6).alias("pearson"), F.round(F.corr("ax", "ay"), 6).alias("spearman"))


@query("""WITH n AS (SELECT r_name AS a, n_name AS b, c_mktsegment AS c FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 p AS (SELECT a AS path FROM n UNION ALL SELECT a || ' > ' || b FROM n UNION ALL SELECT a || ' > ' || b || ' > ' || c FROM n)
 SELECT path, count(*) AS n, round(-ln(count(*)::DOUBLE / (SELECT count(*) FROM n)), 6) AS ic FROM p GROUP BY path""")
def a13_prefix_census(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    rows = c.join(F.broadcast(n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))), F.col("c_nationkey") == F.col("n_nationkey"))
    tree = F.array("r_name", "n_name", "c_mktsegment")
    paths = rows.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.array_join(F.slice(tree, 1, i), " > "))).alias("path")).groupBy("path").agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("t"))
    return paths.crossJoin(F.broadcast(total)).select("path", "n", F.round(-F.log(F.col("n") / F.col("t")), 6).alias("ic"))


@query("SELECT p_brand, p_type, n, round(n / max(n) OVER (PARTITION BY p_brand), 6) AS share, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) = 1 AS home FROM (SELECT p_brand, p_type, count(*)::DOUBLE AS n FROM part GROUP BY 1, 2)")
def a14_a15_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").cast("double").alias("n"))
    w = Window.partitionBy("p_brand")
    return n.select("p_brand", "p_type", "n", F.round(F.col("n") / F.max("n").over(w), 6).alias("share"), (F.row_number().over(w.orderBy(F.desc("n"), "p_type")) == 1).alias("home"))


@query("""WITH e AS (SELECT list_distinct([quantile_cont(o_totalprice, 0.2), quantile_cont(o_totalprice, 0.4), quantile_cont(o_totalprice, 0.6), quantile_cont(o_totalprice, 0.8)]) AS edges FROM orders)
 SELECT bin, count(*) AS n, round(avg(o_totalprice), 2) AS mean FROM (SELECT o_totalprice, len(list_filter(edges, lambda x: x <= o_totalprice)) AS bin FROM orders, e) GROUP BY bin""")
def a18_equal_mass_bins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_totalprice")
    edges = cells.quantiles(spark, rows.withColumn("all", F.lit(0)), ["all"], "o_totalprice", [0.2, 0.4, 0.6, 0.8]).select(F.array_distinct("q").alias("edges"))
    cut = rows.crossJoin(F.broadcast(edges)).select("o_totalprice", F.size(F.filter("edges", lambda x: x <= F.col("o_totalprice"))).cast("long").alias("bin"))
    return cut.groupBy("bin").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 2).alias("mean"))


@query("""SELECT l_returnflag AS cls, count(*) AS n_pop, count(*) FILTER (WHERE l_orderkey % 10 = 0) AS n_gold, round(count(*) FILTER (WHERE l_orderkey % 10 = 0) / count(*)::DOUBLE, 8) AS pi,
 round(CASE WHEN count(*) FILTER (WHERE l_orderkey % 10 = 0) = 0 THEN 0 ELSE count(*)::DOUBLE / count(*) FILTER (WHERE l_orderkey % 10 = 0) END, 6) AS w FROM lineitem GROUP BY 1""")
def a22_inclusion_rates(spark: SparkSession, d: str) -> DataFrame:
    n, g = F.count("*"), F.count_if(F.col("l_orderkey") % 10 == 0)
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("cls")).agg(n.alias("n_pop"), g.alias("n_gold"), F.round(g / n, 8).alias("pi"), F.round(F.when(g == 0, 0.0).otherwise(n / g), 6).alias("w"))


@query("""SELECT bin, n, round(rate, 6) AS rate, round(sd, 6) AS sd, round(rate - 1.96 * sd, 6) AS lo, round(rate + 1.96 * sd, 6) AS hi, round((rate - model) / sd, 4) AS z, abs((rate - model) / sd) > 2 AS flagged FROM (
 SELECT *, sqrt(p * (1 - p) / n) AS sd FROM (SELECT *, CASE WHEN rate IN (0, 1) THEN (rate * n + 0.5) / (n + 1) ELSE rate END AS p FROM (
 SELECT least(floor(l_discount * 100), 9)::INT AS bin, count(*) AS n, avg((l_returnflag = 'R')::INT) AS rate, avg(0.25 + l_discount / 10) AS model FROM lineitem GROUP BY 1)))""")
def a23_bin_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.least(F.floor(F.col("l_discount") * 100), F.lit(9)).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg((F.col("l_returnflag") == "R").cast("int")).alias("rate"), F.avg(0.25 + F.col("l_discount") / 10).alias("model"))
    p = F.when(F.col("rate").isin(0.0, 1.0), (F.col("rate") * F.col("n") + 0.5) / (F.col("n") + 1)).otherwise(F.col("rate"))
    rows = rows.withColumn("sd", F.sqrt(p * (1 - p) / F.col("n"))).withColumn("z", (F.col("rate") - F.col("model")) / F.col("sd"))
    return rows.select("bin", "n", F.round("rate", 6).alias("rate"), F.round("sd", 6).alias("sd"), F.round(F.col("rate") - 1.96 * F.col("sd"), 6).alias("lo"), F.round(F.col("rate") + 1.96 * F.col("sd"), 6).alias("hi"), F.round("z", 4).alias("z"), (F.abs("z") > 2).alias("flagged"))


@query("SELECT tp, fp, fn, tn, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(fp / (fp + tn)::DOUBLE, 6) AS fpr FROM (SELECT count(*) FILTER (WHERE a AND b) AS tp, count(*) FILTER (WHERE a AND NOT b) AS fp, count(*) FILTER (WHERE NOT a AND b) AS fn, count(*) FILTER (WHERE NOT a AND NOT b) AS tn FROM (SELECT o_totalprice > 200000 AS a, o_orderpriority IN ('1-URGENT', '2-HIGH') AS b FROM orders))")
def a25_confusion(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("o_totalprice") > 200000, F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    out = table(spark, d, "orders").agg(F.count_if(a & b).alias("tp"), F.count_if(a & ~b).alias("fp"), F.count_if(~a & b).alias("fn"), F.count_if(~a & ~b).alias("tn"))
    return out.withColumns({"precision": F.round(F.expr("try_divide(tp, tp + fp)"), 6), "recall": F.round(F.expr("try_divide(tp, tp + fn)"), 6), "fpr": F.round(F.expr("try_divide(fp, fp + tn)"), 6)})


@query("SELECT p_brand, arg_max(p_partkey, (p_retailprice, -p_partkey)) AS best, arg_min(p_partkey, (p_retailprice, p_partkey)) AS least FROM part GROUP BY 1")
def a29_arg_max(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.max_by("p_partkey", F.struct("p_retailprice", -F.col("p_partkey"))).alias("best"), F.min_by("p_partkey", F.struct("p_retailprice", "p_partkey")).alias("least"))


@query("SELECT o_orderpriority, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*)::DOUBLE, 3) AS f, round(count(*) FILTER (WHERE o_orderstatus = 'O') / count(*)::DOUBLE, 3) AS o, round(count(*) FILTER (WHERE o_orderstatus = 'P') / count(*)::DOUBLE, 3) AS p FROM orders GROUP BY 1")
def a30_shares(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)
    n = F.col("F") + F.col("O") + F.col("P")
    return out.select("o_orderpriority", *[F.round(F.col(c) / n, 3).alias(c.lower()) for c in "FOP"])


@query("SELECT least(floor(l_discount * 50), 4)::INT AS i, least(floor(l_tax * 50), 3)::INT AS j, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a32_histogram_2d(spark: SparkSession, d: str) -> DataFrame:
    cell = lambda c, n: F.least(F.floor(F.col(c) * 50), F.lit(n)).cast("int")
    return table(spark, d, "lineitem").groupBy(cell("l_discount", 4).alias("i"), cell("l_tax", 3).alias("j")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal > 9000")
def j1_inner_join(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "customer").where("c_acctbal > 9000").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name", "r_name")


@query("SELECT c_custkey, o_orderkey, coalesce(o_totalprice, 0) AS total FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'")
def j2_left_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_orderstatus = 'P'")
    return table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", F.coalesce("o_totalprice", F.lit(0.0)).alias("total"))


@query("SELECT coalesce(a.k, b.k) AS k, a.n AS shipped, b.n AS returned FROM (SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_quantity > 49 GROUP BY 1) a FULL JOIN (SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity < 2 GROUP BY 1) b ON a.k = b.k")
def j3_full_join(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "k")
    a = rows.where("l_quantity > 49").groupBy("k").agg(F.count("*").alias("shipped"))
    b = rows.where("l_returnflag = 'R' AND l_quantity < 2").groupBy("k").agg(F.count("*").alias("returned"))
    return a.join(b, "k", "full")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS big FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def j4_j5_semi_anti(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    left = table(spark, d, "customer").select("c_custkey").join(o.where("o_orderstatus = 'P'"), "c_custkey", "left_anti")
    big = o.where("o_totalprice > 400000").select("c_custkey").distinct().withColumn("big", F.lit(True))
    return left.join(big, "c_custkey", "left").select("c_custkey", F.coalesce("big", F.lit(False)).alias("big"))


@query("SELECT event_id, json_extract(props, '$.k')::INT AS k, coalesce(CASE event_type WHEN 'click' THEN 30 WHEN 'view' THEN 60 END, 100) AS radius FROM events WHERE event_type <> 'error'")
def j9_f_j1_lookup(spark: SparkSession, d: str) -> DataFrame:
    radii = spark.createDataFrame([("click", 30), ("view", 60)], "event_type string, r int")
    rows = table(spark, d, "events").where("event_type <> 'error'").join(F.broadcast(radii), "event_type", "left")
    return rows.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.coalesce("r", F.lit(100)).alias("radius"))


@query("SELECT doc_id, unnest(string_split(source, 'c')) AS part FROM documents")
def j13_unnest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(F.split("source", "c")).alias("part"))


@query("""SELECT * FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER w AS rn, count(*) OVER (PARTITION BY l_orderkey) AS n, max(l_quantity) OVER (PARTITION BY l_orderkey) AS mq,
 round(sum(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING), 2) AS run, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS prev
 FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey)) WHERE rn <= 2""")
def w1_w5_w6_w10_w12_windows(spark: SparkSession, d: str) -> DataFrame:
    p = Window.partitionBy("l_orderkey")
    best, line = p.orderBy(F.desc("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey"), p.orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    out = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.row_number().over(best).alias("rn"), F.count("*").over(p).alias("n"), F.max("l_quantity").over(p).alias("mq"), F.round(F.sum("l_extendedprice").over(line.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("run"), F.lag("l_linenumber").over(line).alias("prev"))
    return out.where("rn <= 2")


@query("SELECT p_brand, p_type, n, rank() OVER (PARTITION BY p_brand ORDER BY n DESC) AS rank, n - max(n) OVER (PARTITION BY p_brand) AS gap FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)")
def w16_rank_gap(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    w = Window.partitionBy("p_brand")
    return n.select("p_brand", "p_type", "n", F.rank().over(w.orderBy(F.desc("n"))).alias("rank"), (F.col("n") - F.max("n").over(w)).alias("gap"))


@query("SELECT c_custkey, c_mktsegment, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('7' || c_custkey::VARCHAR), c_custkey) - 1) % 5 + 1 AS fold FROM customer")
def w15_folds(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.md5(F.concat(F.lit("7"), F.col("c_custkey").cast("string"))).alias("h"))
    return cells.places(spark, rows, ["c_mktsegment"], ["h", "c_custkey"], "n").select("c_custkey", "c_mktsegment", ((F.col("n") - 1) % 5 + 1).cast("long").alias("fold"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t1_t2_top_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT c_mktsegment, c_custkey, c_acctbal, CASE WHEN a <= 3 THEN 'top' ELSE 'bottom' END AS side FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS a, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS b FROM customer) WHERE a <= 3 OR b <= 3")
def t3_extremes(spark: SparkSession, d: str) -> DataFrame:
    w, rows = Window.partitionBy("c_mktsegment"), table(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    # each side by itself, so that tasks cut their rows to three a segment before the shuffle
    first = lambda side, *order: rows.withColumn("n", F.row_number().over(w.orderBy(*order, "c_custkey"))).where("n <= 3").select(*rows.columns, F.lit(side).alias("side"))
    return first("top", F.desc("c_acctbal")).unionByName(first("bottom", F.asc("c_acctbal"))).groupBy(*rows.columns).agg(F.max("side").alias("side"))


@query("WITH t AS (SELECT p_type FROM part GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 3) SELECT p_partkey, p_type FROM part WHERE p_type IN (SELECT p_type FROM t)")
def t4_top_values(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_type")
    top = p.groupBy("p_type").count().orderBy(F.desc("count"), "p_type").limit(3)
    return p.join(F.broadcast(top.select("p_type")), "p_type", "left_semi").select("p_partkey", "p_type")


@query("SELECT 'added' AS change, k FROM (SELECT l_partkey AS k FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' EXCEPT SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1993-01-01') UNION ALL SELECT 'kept', k FROM (SELECT l_partkey AS k FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' INTERSECT SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1993-01-01')")
def u5_set_operations(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), "l_shipdate")
    new, old = rows.where("l_shipdate >= TIMESTAMP '1997-01-01'").select("k"), rows.where("l_shipdate < TIMESTAMP '1993-01-01'").select("k")
    return new.subtract(old).select(F.lit("added").alias("change"), "k").unionByName(new.intersect(old).select(F.lit("kept").alias("change"), "k"))


@query("SELECT k, version, part FROM (SELECT *, min(part) OVER (PARTITION BY k) AS m FROM (SELECT o_custkey AS k, o_orderkey AS version, 0 AS part FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, o_orderkey, 1 FROM orders WHERE o_orderstatus <> 'F')) WHERE part = m")
def u3_first_wins(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    part = lambda status, n: o.where(status).select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("version"), F.lit(n).alias("part"))
    return first_wins([part("o_orderstatus = 'F'", 0), part("o_orderstatus <> 'F'", 1)], ["k"])


@query("SELECT DISTINCT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def u2_u7_distinct_union(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return a.union(b).distinct()


TERMS = {"ground": ["survey", "view"], "online": ["click", "web"], "import_other": ["sign", "purch"]}


@query("SELECT kind, count(*) AS n FROM (SELECT CASE WHEN lower(event_type) LIKE '%survey%' OR lower(event_type) LIKE '%view%' THEN 'ground' WHEN lower(event_type) LIKE '%click%' OR lower(event_type) LIKE '%web%' THEN 'online' WHEN lower(event_type) LIKE '%sign%' OR lower(event_type) LIKE '%purch%' THEN 'import_other' ELSE 'uncategorized' END AS kind FROM events) GROUP BY 1")
def p16_like_buckets(spark: SparkSession, d: str) -> DataFrame:
    x = F.lower("event_type")
    kind = reduce(lambda acc, kv: acc.when(reduce(lambda a, b: a | b, [x.contains(t) for t in kv[1]]), kv[0]), TERMS.items(), F.when(F.col("event_type").isNull(), None))
    return table(spark, d, "events").select(kind.otherwise("uncategorized").alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN c_acctbal > 8000 THEN 'gold' WHEN c_mktsegment = 'BUILDING' THEN 'segment' WHEN c_nationkey IS NOT NULL THEN 'nation' END AS tag FROM customer WHERE NOT (c_acctbal < 0 AND c_mktsegment IN ('MACHINERY', 'BUILDING')) AND (c_acctbal BETWEEN 100 AND 5000 OR c_acctbal BETWEEN 7000 AND 9500)")
def p2_p8_p10_predicates(spark: SparkSession, d: str) -> DataFrame:
    boxes = reduce(lambda a, b: a | b, [F.col("c_acctbal").between(lo, hi) for lo, hi in ((100, 5000), (7000, 9500))])
    hidden = (F.col("c_acctbal") < 0) & F.coalesce(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), F.lit(False))
    tag = F.coalesce(F.when(F.col("c_acctbal") > 8000, F.lit("gold")), F.when(F.col("c_mktsegment") == "BUILDING", F.lit("segment")), F.when(F.col("c_nationkey").isNotNull(), F.lit("nation")))
    return table(spark, d, "customer").where(~hidden & boxes).select("c_custkey", tag.alias("tag"))
