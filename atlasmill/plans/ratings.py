"""Ratings from curves and the statistics of fits, on stand-ins derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.operators import rating
from atlasmill.plans.registry import query
from atlasmill.session import table


@query("""SELECT c_custkey, CASE WHEN pop > 100000 AND coalesce(dens, 0) > 1000 THEN 'urban' WHEN coalesce(dens, 0) > 500 THEN 'suburban' ELSE 'rural' END AS kind
 FROM (SELECT c_custkey, c_nationkey * 10000 AS pop, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS dens FROM customer)""")
def d24_urban_class(spark: SparkSession, d: str) -> DataFrame:
    dens = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return table(spark, d, "customer").select("c_custkey", rating.urban_class(F.col("c_nationkey") * 10000, dens).alias("kind"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(exp(-r * t), 8) AS conf_mean, round(exp(-r * t * 1.1), 8) AS conf_lower, round(exp(-r * t * 0.9), 8) AS conf_upper
 FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 0.01 WHEN 'N' THEN 0.02 ELSE 0.03 END AS r, l_quantity::INT AS t FROM lineitem)""")
def d27_group_lookup(spark: SparkSession, d: str) -> DataFrame:
    p = lambda r: [(1 - F.exp(-F.lit(r) * F.col("t") * w)).alias(c) for c, w in (("mean", 1.0), ("lower", 0.9), ("upper", 1.1))]
    ages = spark.range(101).select(F.col("id").cast("int").alias("t"))
    curves = ages.select(F.lit("A").alias("l_returnflag"), "t", *p(0.01)).unionByName(ages.select(F.lit("N").alias("l_returnflag"), "t", *p(0.02)))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_quantity").cast("int").alias("t"))
    out = rating.group_lookup(rows, curves, ages.select("t", *p(0.03)), "l_returnflag", "t")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(c, 8).alias(c) for c in ("conf_mean", "conf_lower", "conf_upper")])


@query("""WITH c AS (SELECT c_custkey, c_mktsegment AS seg, c_nationkey AS msa, floor((c_acctbal + 1000) / 1100)::INT AS t FROM customer), k AS (SELECT DISTINCT seg, msa, t FROM c),
 x AS (SELECT seg, msa, t, 0.95 * exp(-exp(-2.5 + 0.02 * i + CASE WHEN seg <> 'MACHINERY' THEN 0.05 * ((length(seg) * 3 + i * 7) % 11) ELSE 0 END + 0.03 * ((msa * 5 + i) % 7)) * t) AS v FROM k, (SELECT unnest(range(20)) AS i)),
 q AS (SELECT seg, msa, t, avg(v) AS m, quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi FROM x GROUP BY 1, 2, 3)
 SELECT c_custkey, round(m, 7) AS conf_mean, round(lo, 7) AS conf_lower, round(hi, 7) AS conf_upper FROM c JOIN q USING (seg, msa, t)""")
def d26_m5_cell_curves(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("msa"), F.floor((F.col("c_acctbal") + 1000) / 1100).cast("int").alias("t"))
    base = spark.range(20).select(F.col("id").alias("draw"), (-2.5 + 0.02 * F.col("id")).alias("value"))
    draws = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))).alias("draw")
    seg = rows.select("seg").where("seg <> 'MACHINERY'").distinct().select("seg", draws).withColumn("value", 0.05 * ((F.length("seg") * 3 + F.col("draw") * 7) % 11))
    msa = rows.select("msa").distinct().select("msa", draws).withColumn("value", 0.03 * ((F.col("msa") * 5 + F.col("draw")) % 7))
    out = rating.cell_curves(rows, base, {"seg": seg, "msa": msa}, "t", 0.05, 0.9)
    return out.select("c_custkey", *[F.round(c, 7).alias(c) for c in ("conf_mean", "conf_lower", "conf_upper")])


LL = "CASE WHEN y THEN ln(1 - (CASE WHEN first THEN 0.9 ELSE 1 END) * exp(-r * t)) ELSE -r * t + CASE WHEN first THEN ln(0.9) ELSE 0 END END"


@query(f"""WITH o AS (SELECT c_custkey, (c_acctbal + 1500) / 2000 AS t, c_nationkey < 8 AS first, c_mktsegment = 'BUILDING' AS y FROM customer),
 l AS (SELECT c_custkey, first, t, y, {LL} AS ll FROM o, (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5]) AS r)),
 p AS (SELECT c_custkey, ln(avg(exp(ll))) AS l, var_samp(ll) AS v, any_value((1 - exp(-0.3 * t) - y::INT) ** 2) AS e FROM l GROUP BY c_custkey)
 SELECT round(sum(l), 4) AS lppd, round(sum(v), 4) AS p_waic, round(-2 * (sum(l) - sum(v)), 4) AS waic, round(sqrt(avg(e)), 7) AS rmse, count(*) AS n FROM p""")
def a27_m1_m6_fit_scores(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(((F.col("c_acctbal") + 1500) / 2000).alias("t"), (F.col("c_nationkey") < 8).alias("first"), (F.col("c_mktsegment") == "BUILDING").alias("y"))
    ll = F.transform(F.array(*[F.lit(r) for r in (0.1, 0.2, 0.3, 0.4, 0.5)]), lambda r: rating.zie_loglik(r * F.col("t"), F.col("first"), F.lit(0.1), F.col("y")))
    out = rating.fit_scores(c, ll, 1 - F.exp(-0.3 * F.col("t")), F.col("y").cast("int"))
    return out.select(*[F.round(x, 4).alias(x) for x in ("lppd", "p_waic", "waic")], F.round("rmse", 7).alias("rmse"), "n")


@query("""WITH k AS (SELECT l_shipmode_key, sum(y) AS y, sum(p) AS e, sum(p * (1 - p)) AS v FROM (SELECT l_returnflag || l_linestatus || l_linenumber::VARCHAR AS l_shipmode_key, (l_discount > 0.05)::INT AS y, 0.2 + l_tax * 3 AS p FROM lineitem) GROUP BY 1)
 SELECT count(*) AS cells, round(avg((y - e) ** 2 / v), 6) AS phi FROM k WHERE v > 0""")
def m7_dispersion(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", (F.col("l_discount") > 0.05).cast("int").alias("y"), (0.2 + F.col("l_tax") * 3).alias("p"))
    return rating.dispersion(rows, ["l_returnflag", "l_linestatus", "l_linenumber"], "p", "y").select("cells", F.round("phi", 6).alias("phi"))


@query("""WITH t AS (SELECT * FROM events WHERE event_type IN ('click', 'view')), f AS (SELECT * FROM events WHERE event_type IN ('view', 'error')), b AS (SELECT min(ts)::DATE + INTERVAL 5 DAY AS lo, min(ts)::DATE + INTERVAL 12 DAY AS hi FROM events),
 tw AS (SELECT t.user_id FROM t, b WHERE ts >= lo AND ts < hi), fw AS (SELECT f.user_id FROM f, b WHERE ts >= lo AND ts < hi),
 tp AS (SELECT DISTINCT t.user_id FROM t, b WHERE ts >= lo - INTERVAL 1 DAY AND ts < hi + INTERVAL 1 DAY), fp AS (SELECT DISTINCT f.user_id FROM f, b WHERE ts >= lo - INTERVAL 1 DAY AND ts < hi + INTERVAL 1 DAY)
 SELECT (SELECT round(avg((user_id IN (SELECT user_id FROM fp))::INT), 8) FROM tw) AS recall, (SELECT count(*) FROM tw) AS n_recall, (SELECT round(avg((user_id IN (SELECT user_id FROM tp))::INT), 8) FROM fw) AS precision, (SELECT count(*) FROM fw) AS n_precision""")
def a26_event_overlap(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "ts", "event_type")
    lo, hi = e.agg(F.date_add(F.to_date(F.min("ts")), 5).cast("string"), F.date_add(F.to_date(F.min("ts")), 12).cast("string")).first()
    out = rating.event_overlap(e.where("event_type IN ('click', 'view')"), e.where("event_type IN ('view', 'error')"), ["user_id"], "ts", lo, hi)
    return out.select(F.round("recall", 8).alias("recall"), "n_recall", F.round("precision", 8).alias("precision"), "n_precision")


@query("""WITH b AS (SELECT p_partkey + 1 AS p_partkey, p_name, p_brand, CASE WHEN p_size = 1 THEN 2 ELSE p_size END AS p_size FROM part)
 SELECT 'p_partkey' AS "column", NOT EXISTS (SELECT p_partkey FROM part EXCEPT ALL SELECT p_partkey FROM b) AS same UNION ALL SELECT 'p_name', NOT EXISTS (SELECT p_name FROM part EXCEPT ALL SELECT p_name FROM b)
 UNION ALL SELECT 'p_brand', NOT EXISTS (SELECT p_brand FROM part EXCEPT ALL SELECT p_brand FROM b) UNION ALL SELECT 'p_size', NOT EXISTS (SELECT p_size FROM part EXCEPT ALL SELECT p_size FROM b)""")
def a28_same_columns(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    b = a.withColumns({"p_partkey": F.col("p_partkey") + 1, "p_size": F.when(F.col("p_size") == 1, 2).otherwise(F.col("p_size")).cast(a.schema["p_size"].dataType)})
    return rating.same_columns(a, b, a.columns)


@query("SELECT l_returnflag, l_linenumber, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) AS l_discount FROM lineitem GROUP BY 1, 2")
def a31_weighted_curves(spark: SparkSession, d: str) -> DataFrame:
    return rating.weighted_curves(table(spark, d, "lineitem"), ["l_returnflag", "l_linenumber"], "l_discount", "l_quantity").withColumn("l_discount", F.round("l_discount", 8))


@query("""WITH s AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE l_discount BETWEEN l_tax - 0.03 AND l_tax + 0.09) AS c, sum(l_tax - l_discount) AS b, bool_and(l_discount BETWEEN l_tax - 0.03 AND l_tax + 0.09) AS every FROM lineitem GROUP BY 1)
 SELECT round(sum(c) / sum(n), 8) AS covered, round(sum(b) / sum(n), 8) AS bias, count(*) AS sims, round(avg(every::INT), 8) AS simultaneous FROM s""")
def a33_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_discount", "l_tax", (F.col("l_tax") - 0.03).alias("lo"), (F.col("l_tax") + 0.09).alias("hi"))
    out = rating.coverage(rows, "l_suppkey", "l_discount", "l_tax", "lo", "hi")
    return out.select(F.round("covered", 8).alias("covered"), F.round("bias", 8).alias("bias"), "sims", F.round("simultaneous", 8).alias("simultaneous"))


@query("""WITH m AS (SELECT p_size // 5 AS i, (p_retailprice / 250)::INT AS j, avg(p_retailprice) AS m FROM part GROUP BY 1, 2)
 SELECT (g // 12)::INT AS i, (g % 12)::INT AS j, round(m, 4) AS mean, m IS NULL AS empty FROM (SELECT unnest(range(144)) AS g) LEFT JOIN m ON i = g // 12 AND j = g % 12""")
def a34_cell_means(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.floor(F.col("p_size") / 5).alias("i"), F.bround(F.col("p_retailprice") / 250).alias("j"), "p_retailprice")
    out = rating.cell_means(rows, "p_retailprice", "i", "j", (12, 12))
    return out.select("i", "j", F.round(F.when(~F.isnan("mean"), F.col("mean")), 4).alias("mean"), F.isnan("mean").alias("empty"))


@query("SELECT o_orderpriority, round((sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) + 0.5) / (sum(o_totalprice) + 1), 8) AS rate FROM orders GROUP BY 1")
def m15_jeffreys_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderpriority", (F.col("o_orderstatus") == "F").alias("hit"), "o_totalprice")
    return rating.jeffreys_rates(rows, ["o_orderpriority"], "hit", "o_totalprice").withColumn("rate", F.round("rate", 8))


@query("""SELECT p_brand, g AS "at", round(sum(exp(-0.5 * ((g - p_size) / 5.0) ** 2) * p_retailprice) / sum(exp(-0.5 * ((g - p_size) / 5.0) ** 2)), 4) AS p_retailprice
 FROM part, (SELECT unnest([0.0::DOUBLE, 10, 20, 30, 40, 50]) AS g) GROUP BY 1, 2""")
def m9_kernel_curve(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_brand", "p_size", "p_retailprice", F.lit(1.0).alias("w"))
    return rating.kernel_curve(rows, "p_brand", "p_size", "p_retailprice", "w", [0, 10, 20, 30, 40, 50], 5.0).withColumn("p_retailprice", F.round("p_retailprice", 4))


@query("""WITH k AS (SELECT p_brand, p_size, count(*)::DOUBLE AS w, sum(p_retailprice) AS wy FROM part GROUP BY 1, 2),
 s AS (SELECT *, sum(w) OVER u AS cw, sum(wy) OVER u AS cy FROM k WINDOW u AS (PARTITION BY p_brand ORDER BY p_size)),
 m AS (SELECT a.p_brand, a.p_size AS i, b.p_size AS j, (b.cy - a.cy + a.wy) / (b.cw - a.cw + a.w) AS v FROM s a JOIN s b ON a.p_brand = b.p_brand AND a.p_size <= b.p_size),
 n AS (SELECT k.p_brand, k.p_size, m.i, min(v) AS v FROM k JOIN m ON m.p_brand = k.p_brand AND m.i <= k.p_size AND m.j >= k.p_size GROUP BY 1, 2, 3)
 SELECT p_brand, p_size::DOUBLE AS p_size, round(max(v), 4) AS p_retailprice FROM n GROUP BY 1, 2""")
def m8_isotonic(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_brand", "p_size", "p_retailprice", F.lit(1.0).alias("w"))
    return rating.isotonic(rows, "p_brand", "p_size", "p_retailprice", "w").withColumn("p_retailprice", F.round("p_retailprice", 4))


@query("""SELECT p_brand, p_size, mean, before FROM (SELECT p_brand, p_size, round(m, 4) AS mean, round(lag(m) OVER (PARTITION BY p_brand ORDER BY p_size), 4) AS before, m - lag(m) OVER (PARTITION BY p_brand ORDER BY p_size) AS diff FROM (SELECT p_brand, p_size, avg(p_retailprice) AS m FROM part GROUP BY 1, 2)) WHERE diff < -1.0""")
def m17_falls(spark: SparkSession, d: str) -> DataFrame:
    curve = table(spark, d, "part").groupBy("p_brand", "p_size").agg(F.avg("p_retailprice").alias("mean"))
    return rating.falls(curve, "p_brand", "p_size", "mean", 1.0).select("p_brand", "p_size", F.round("mean", 4).alias("mean"), F.round("before", 4).alias("before"))
