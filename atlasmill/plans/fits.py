"""Fits and checks, unions and single windows, on stand-ins derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.functions import numeric, text
from atlasmill.operators import cells, lookup, models
from atlasmill.plans.domain import L, _left
from atlasmill.plans.registry import query
from atlasmill.session import table
from atlasmill.streaming import feed

XS, YS, GRID = [0.0, 0.3, 1.0], [0.0, 0.5, 1.0], [[0.05, 0.2, 0.4], [0.1, 0.5, 0.7], [0.3, 0.8, 0.95]]


def _bilinear_sql() -> str:
    cases = []
    for i in range(2):
        for j in range(2):
            s, t = f"(x - {XS[i]}) / {XS[i + 1] - XS[i]!r}", f"(y - {YS[j]}) / {YS[j + 1] - YS[j]!r}"
            g = [[GRID[i + a][j + b] for b in (0, 1)] for a in (0, 1)]
            cases.append(f"WHEN x <= {XS[i + 1]} AND y <= {YS[j + 1]} THEN ({g[0][0]} * (1 - {t}) + {g[0][1]} * {t}) * (1 - {s}) + ({g[1][0]} * (1 - {t}) + {g[1][1]} * {t}) * {s}")
    return "CASE " + " ".join(cases) + " END"


@query(f"SELECT p_partkey, round(CASE seg WHEN 'a' THEN {_bilinear_sql()} WHEN 'b' THEN x * 0.5 ELSE 0.2 END, 8) AS conf FROM (SELECT p_partkey, least(1, p_size / 45.0::DOUBLE) AS x, least(1, p_retailprice / 2000) AS y, CASE p_partkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS seg FROM part)")
def d22_surfaces(spark: SparkSession, d: str) -> DataFrame:
    seg = F.when(F.col("p_partkey") % 3 == 0, "a").when(F.col("p_partkey") % 3 == 1, "b")
    rows = table(spark, d, "part").select("p_partkey", (F.col("p_size") / 45.0).alias("x"), (F.col("p_retailprice") / 2000).alias("y"), seg.alias("seg"))
    curves = {"a": models.bilinear(F.col("x"), F.col("y"), XS, YS, GRID), "b": F.least(F.col("x"), F.lit(1.0)) * 0.5}
    return rows.select("p_partkey", F.round(models.by_segment(F.col("seg"), curves, F.lit(0.2)), 8).alias("conf"))


DRAWS = [0.05 + 0.01 * ((7 * k) % 11) for k in range(11)]


@query(f"""WITH r AS (SELECT unnest({DRAWS}::DOUBLE[]) AS r), p AS (SELECT l_linenumber, 1 - exp(-r * l_linenumber) AS p FROM (SELECT DISTINCT l_linenumber FROM lineitem), r)
 SELECT l_linenumber, round(avg(p), 8) AS mean, round(quantile_cont(p, 0.05), 8) AS lower, round(quantile_cont(p, 0.95), 8) AS upper FROM p GROUP BY 1""")
def d28_draws(spark: SparkSession, d: str) -> DataFrame:
    ages = table(spark, d, "lineitem").select("l_linenumber").distinct()
    mean, lower, upper = models.over_draws("constant", F.lit(0.0), F.col("l_linenumber").cast("double"), [{"rate": r} for r in DRAWS], 0.9)
    return ages.select("l_linenumber", F.round(mean, 8).alias("mean"), F.round(lower, 8).alias("lower"), F.round(upper, 8).alias("upper"))


U = "('0x' || left(md5({key}::VARCHAR || ':' || {rep}::VARCHAR), 8))::BIGINT / 4294967296.0"


@query(f"""WITH r AS (SELECT p_partkey, p_brand, (p_size > 25)::INT AS y, 0.3 + p_retailprice / 10000 AS p FROM part), k AS (SELECT p_brand, rep, sum(p) AS e, sum(p * (1 - p)) AS v, sum(CASE WHEN rep < 0 THEN y ELSE ({U.format(key='p_partkey', rep='rep')} < p)::INT END) AS n FROM r, (SELECT unnest(range(-1, 20)) AS rep) GROUP BY 1, 2),
 f AS (SELECT rep, avg((n - e) ** 2 / v) AS phi FROM k GROUP BY 1) SELECT round((SELECT phi FROM f WHERE rep < 0), 8) AS phi, (SELECT avg((phi >= (SELECT phi FROM f WHERE rep < 0))::INT) FROM f WHERE rep >= 0) AS p""")
def m7_predictive_p(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", "p_brand", (F.col("p_size") > 25).cast("int").alias("y"), (0.3 + F.col("p_retailprice") / 10000).alias("p"))
    return models.predictive_p(rows, "p_partkey", ["p_brand"], "p", "y").select(F.round("phi", 8).alias("phi"), "p")


@query(f"""WITH r AS (SELECT *, floor({U.format(key='o_orderkey', rep="'fold'")} * 5)::INT AS fold FROM (SELECT o_orderkey, o_orderpriority AS c, 1 + o_orderkey % 7 AS t, (o_orderstatus = 'F')::INT AS y FROM orders)), o AS (SELECT c, fold, sum(y) AS y, sum(t) AS t FROM r GROUP BY 1, 2), a AS (SELECT c, sum(y) AS y, sum(t) AS t FROM o GROUP BY 1),
 p AS (SELECT r.fold, r.y, 1 - exp(-(a.y - o.y + 0.5) / (a.t - o.t + 1) * r.t) AS p FROM r JOIN o USING (c, fold) JOIN a USING (c)) SELECT fold, count(*) AS n, round(avg((p - y) ** 2), 8) AS brier, round(avg(ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)), 8) AS log_score FROM p GROUP BY 1""")
def m6_cross_validation(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("c"), (1 + F.col("o_orderkey") % 7).cast("double").alias("t"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return models.cross_validated(rows, "o_orderkey", ["c"], "t", "y", 5).withColumns({c: F.round(c, 8) for c in ("brier", "log_score")})


@query("""WITH r AS (SELECT c_mktsegment AS s, round((c_acctbal + 1000) / 11000, 2) AS x, (c_acctbal + 1000) / 12000 AS q, CASE WHEN c_custkey % 4 = 0 THEN (c_custkey % 8 = 0)::INT END AS y FROM customer)
 SELECT s, g AS "at", round(least(1, greatest(0, sum(exp(-0.5 * ((g - x) / 0.15) ** 2) * (q + CASE WHEN y IS NOT NULL THEN 4.0 * (y - q) ELSE 0 END)) / sum(exp(-0.5 * ((g - x) / 0.15) ** 2)))), 6) AS estimate FROM r, (SELECT unnest([0.1::DOUBLE, 0.5, 0.9]) AS g) GROUP BY 1, 2""")
def m9_difference_curve(spark: SparkSession, d: str) -> DataFrame:
    y = F.when(F.col("c_custkey") % 4 == 0, (F.col("c_custkey") % 8 == 0).cast("int"))
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("s"), F.round((F.col("c_acctbal") + 1000) / 11000, 2).alias("x"), ((F.col("c_acctbal") + 1000) / 12000).alias("q"), y.alias("y"), F.lit(4.0).alias("w"))
    return models.difference_curve(rows, "s", "x", "q", "y", "w", [0.1, 0.5, 0.9], 0.15).withColumn("estimate", F.round("estimate", 6))


POISSON = "(u > 0.36787944117144233)::INT + (u > 0.7357588823428847)::INT + (u > 0.9196986029286058)::INT + (u > 0.9810118431238462)::INT + (u > 0.9963401531726563)::INT"


@query(f"""WITH w AS (SELECT c_mktsegment, c_acctbal, rep, {POISSON} AS k FROM (SELECT c_mktsegment, c_acctbal, rep, {U.format(key='c_custkey', rep='rep')} AS u FROM customer, (SELECT unnest(range(40)) AS rep))), b AS (SELECT c_mktsegment, rep, sum(k * c_acctbal) / sum(k) AS m FROM w GROUP BY 1, 2)
 SELECT c_mktsegment, (SELECT round(avg(c_acctbal), 4) FROM customer c WHERE c.c_mktsegment = b.c_mktsegment) AS mean, round(quantile_cont(m, 0.05), 4) AS lower, round(quantile_cont(m, 0.95), 4) AS upper FROM b GROUP BY 1""")
def m10_bootstrap_bands(spark: SparkSession, d: str) -> DataFrame:
    return models.bootstrap_bands(table(spark, d, "customer"), "c_custkey", ["c_mktsegment"], "c_acctbal").select("c_mktsegment", *[F.round(c, 4).alias(c) for c in ("mean", "lower", "upper")])


@query("""WITH r AS (SELECT p_size / 60.0::DOUBLE AS x, (p_partkey % 60 < p_size)::INT AS y FROM part), k AS (SELECT round(x, 4) AS x, count(*)::DOUBLE AS w, sum(y)::DOUBLE AS wy FROM r GROUP BY 1), s AS (SELECT *, sum(w) OVER (ORDER BY x) AS cw, sum(wy) OVER (ORDER BY x) AS cy FROM k),
 m AS (SELECT a.x AS i, b.x AS j, (b.cy - a.cy + a.wy) / (b.cw - a.cw + a.w) AS v FROM s a JOIN s b ON a.x <= b.x), f AS (SELECT x, max(v) AS fit FROM (SELECT k.x, m.i, min(v) AS v FROM k JOIN m ON m.i <= k.x AND m.j >= k.x GROUP BY 1, 2) GROUP BY 1),
 t AS (SELECT round(r.x, 4) AS x, y, fit FROM r JOIN f ON round(r.x, 4) = f.x) SELECT round(avg((x - y) ** 2), 8) AS brier, round(avg(ln(greatest(CASE WHEN y = 1 THEN x ELSE 1 - x END, 1e-12))), 8) AS log_score, round(avg((x - y) ** 2) - avg((fit - y) ** 2), 8) AS miscalibration, round(var_pop(y) - avg((fit - y) ** 2), 8) AS discrimination, round(var_pop(y), 8) AS uncertainty FROM t""")
def m12_score_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select((F.col("p_size") / 60.0).alias("p"), (F.col("p_partkey") % 60 < F.col("p_size")).cast("int").alias("y"))
    out = models.score_parts(rows, "p", "y")
    return out.select(*[F.round(c, 8).alias(c) for c in out.columns])


@query("""WITH r AS (SELECT least(floor(p * 10), 9)::INT AS bin, p, y, w FROM (SELECT p_size / 60.0::DOUBLE AS p, (p_partkey % 60 < p_size)::INT AS y, 1 + p_partkey % 3 AS w FROM part)), m AS (SELECT bin, sum(w * y) / sum(w) AS m FROM r GROUP BY 1),
 k AS (SELECT r.bin, count(*) AS n, sum(w * p) / sum(w) AS p, any_value(m) AS y, sqrt(sum(w * w * (y - m) ** 2)) / sum(w) AS se FROM r JOIN m USING (bin) GROUP BY 1) SELECT bin, n, round(p, 8) AS p, round(y, 8) AS y, round(se, 8) AS se, round(CASE WHEN se > 0 THEN (y - p) / se END, 6) AS z FROM k""")
def m16_design_check(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select((F.col("p_size") / 60.0).alias("p"), (F.col("p_partkey") % 60 < F.col("p_size")).cast("int").alias("y"), (1 + F.col("p_partkey") % 3).cast("double").alias("w"))
    return models.design_check(rows, "p", "y", "w").select("bin", "n", *[F.round(c, 8).alias(c) for c in ("p", "y", "se")], F.round("z", 6).alias("z"))


@query("SELECT DISTINCT c_mktsegment, c_nationkey % 5 AS g FROM customer")
def a7_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_mktsegment", (F.col("c_nationkey") % 5).alias("g")).distinct()


@query("SELECT o_orderkey AS k, 'o' AS src FROM orders UNION ALL SELECT c_custkey, 'c' FROM customer UNION ALL SELECT c_custkey, 'c' FROM customer WHERE c_nationkey = 1")
def u1_union_all(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit("o").alias("src")), table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("c").alias("src"), "c_nationkey")
    return o.unionByName(c.drop("c_nationkey")).unionByName(c.where("c_nationkey = 1").drop("c_nationkey"))


@query("""WITH a AS (SELECT user_id AS k, event_id FROM events WHERE event_type = 'signup'), b AS (SELECT user_id AS k, event_id FROM events WHERE event_type IN ('view', 'click')) SELECT * FROM a UNION ALL SELECT * FROM b WHERE k NOT IN (SELECT k FROM a)""")
def u4_first_rank(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("k"), "event_id", "event_type")
    return lookup.first_wins([e.where("event_type = 'signup'").drop("event_type"), e.where("event_type IN ('view', 'click')").drop("event_type")], ["k"])


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) = 1")
def w4_best_edge(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id", "event_type").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").withColumn("n", F.row_number().over(w)).where("n = 1").select("user_id", "event_type", "event_id")


@query("""SELECT event_id, max((event_type = 'signup')::INT) OVER w AS gate, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER w AS held, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def w7_w8_w9_carry(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    so_far, own = w.rowsBetween(Window.unboundedPreceding, 0), F.when(F.col("event_type") == "signup", F.col("value"))
    return table(spark, d, "events").select("event_id", F.max((F.col("event_type") == "signup").cast("int")).over(so_far).alias("gate"), F.last(own, True).over(so_far).alias("held"), F.last(own, True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))


@query("""SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN '' ELSE 'Q' || p_size::VARCHAR END AS qid, list_has_all(string_split(p_name, ' '), string_split(lower(p_type), ' ')) AS inside, upper(left(p_name, 1)) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(left(split_part(p_name, ' ', 2), 1)) || split_part(p_name, ' ', 2)[2:] || ' (N = ' || p_size::VARCHAR || ')' AS title FROM part""")
def fs4_fs9_fs14_texts(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("p_size") % 10 == 0, F.concat(F.lit("Q0"), F.col("p_size").cast("string"))).otherwise(F.concat(F.lit(" q"), F.col("p_size").cast("string")))
    return table(spark, d, "part").select("p_partkey", text.wikidata(raw).alias("qid"), text.token_subset(F.col("p_name"), F.lower("p_type")).alias("inside"), text.title(F.replace("p_name", F.lit(" "), F.lit("_")), F.col("p_size")).alias("title"))


def _geohash_sql(n: int = 6) -> str:
    nx = ny = 5 * n // 2
    bit = lambda b: f"((x >> {nx - 1 - b // 2}) & 1)" if b % 2 == 0 else f"((y >> {ny - 1 - b // 2}) & 1)"
    digits = ["(" + " + ".join(f"{bit(5 * c + k)} * {16 >> k}" for k in range(5)) + ")" for c in range(n)]
    return " || ".join(f"substr('{numeric.BASE32}', ({g} + 1)::INT, 1)" for g in digits), nx, ny


HASH, NX, NY = _geohash_sql()


@query(f"SELECT osm, {HASH} AS geohash FROM (SELECT osm, floor((lon + 180) / 360 * {1 << NX})::BIGINT AS x, floor((lat + 90) / 180 * {1 << NY})::BIGINT AS y FROM ({L}))")
def fg4_geohash(spark: SparkSession, d: str) -> DataFrame:
    return _left(spark, d).select("osm", numeric.geohash(F.col("lon"), F.col("lat")).alias("geohash"))


@query("SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN (ts::DATE + INTERVAL 1 DAY)::TIMESTAMP ELSE ts END AS ts, event_type = 'error' AS deleted FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def st4_daily_versions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", (F.col("event_type") == "error").alias("deleted"))
    return models.collapse_days(rows, "user_id", ["ts", "event_id"], "ts", "deleted")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01' - INTERVAL 3 YEAR")
def st6_recent(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return feed.recent(o, "o_orderdate", F.lit("2001-06-01").cast(o.schema["o_orderdate"].dataType), 3).select("o_orderkey")


@query("SELECT p_partkey, p_size * 2 AS twice FROM part WHERE p_size > 10")
def udf_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", "p_size")
    return models.transform_batches(rows, lambda b: b[b.p_size > 10].assign(twice=b.p_size * 2)[["p_partkey", "twice"]], "p_partkey long, twice long")


@query()
def m3_m4_random_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates of discounts above 0.05 by flag: means of the draws, r-hat and effective draws. A sampler has no SQL."""
    rows = table(spark, d, "lineitem").select("l_returnflag", (F.col("l_quantity") / 25).alias("t"), (F.col("l_linenumber") == 1).alias("first"), (F.col("l_discount") > 0.08).alias("changed"))
    names, draws = models.fit_random_rates(*cells.sufficient_stats(rows, ["l_returnflag"], "t", "first", "changed"), "l_returnflag", "t", warm=4000, draws=8000, chains=2)
    told = zip(names, draws[:, :, 2:].mean(axis=(0, 1)), models.r_hat(draws)[2:], models.effective(draws)[2:], strict=True)
    return spark.createDataFrame([(n, float(m), float(r), float(e)) for n, m, r, e in told], "cell string, log_rate double, r_hat double, effective double")
