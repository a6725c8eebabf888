"""Sources and sinks: each query writes a stand-in to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.plans.domain import L, _left
from atlasmill.plans.feeds import _folder
from atlasmill.plans.registry import query
from atlasmill.session import table
from atlasmill.sources import files


@query("SELECT count(*) AS n, 0::BIGINT AS first, count(*) - 1 AS last, 1::BIGINT AS files FROM part")
def s4_positions(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "s4")
    table(spark, d, "part").coalesce(1).write.parquet(path)
    return files.with_positions(spark, path).agg(F.count("*").alias("n"), F.min("row").alias("first"), F.max("row").alias("last"), F.count_distinct("file").alias("files"))


@query("SELECT '2026-02-01' AS release, count(*) AS n FROM supplier WHERE s_nationkey = 2 UNION ALL SELECT '2026-01-01', count(*) FROM supplier WHERE s_nationkey = 1")
def s6_k10_releases(spark: SparkSession, d: str) -> DataFrame:
    root = _folder(spark, "s6")
    for month in (1, 2):
        table(spark, d, "supplier").where(F.col("s_nationkey") == month).write.parquet(f"{root}/staged/2026-0{month}-01")
        files.publish(spark, f"{root}/staged/2026-0{month}-01", f"{root}/out/2026-0{month}-01")
    last = files.latest_release(spark, f"{root}/out")
    read = lambda name: spark.read.parquet(*files.part_keys(spark, f"{root}/out/{name}")).agg(F.lit(name).alias("release"), F.count("*").alias("n"))
    return read(last).unionByName(read(files.latest_release(spark, f"{root}/out", last)))


@query("SELECT n_nationkey::VARCHAR AS code, CASE WHEN n_nationkey % 5 = 0 THEN 'NA' WHEN n_nationkey % 5 = 1 THEN '' ELSE lpad(n_nationkey::VARCHAR, 3, '0') END AS value FROM nation")
def s7_k7_lookup(spark: SparkSession, d: str) -> DataFrame:
    k, path = F.col("n_nationkey"), _folder(spark, "s7")
    rows = table(spark, d, "nation").select(k.alias("code"), F.when(k % 5 == 0, "NA").when(k % 5 == 1, "").otherwise(F.lpad(k.cast("string"), 3, "0")).alias("value"))
    files.write_csv(rows, path, ["code"])
    return files.read_lookup(spark, path)


@query("SELECT n_nationkey::BIGINT AS cell, round(n_nationkey / 7.0, 4)::DOUBLE AS rate FROM nation")
def s8_model(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "s8")
    files.write_csv(table(spark, d, "nation").select(F.col("n_nationkey").alias("cell"), F.round(F.col("n_nationkey") / 7.0, 4).alias("rate")), path)
    return files.read_model(spark, path, "cell long, rate double")


@query("SELECT event_id FROM events WHERE ('0x' || left(md5(user_id::VARCHAR || ':7'), 8))::BIGINT < (0.4 * 4294967296)::BIGINT")
def s16_sample(spark: SparkSession, d: str) -> DataFrame:
    return files.sample_keys(table(spark, d, "events"), "user_id", 0.4, 7).select("event_id")


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status FROM orders")
def k1_appended_parts(spark: SparkSession, d: str) -> DataFrame:
    path, o = _folder(spark, "k1"), table(spark, d, "orders")
    o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status")).write.parquet(f"{path}/a")
    o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("o_orderkey"), "o_totalprice").write.parquet(f"{path}/b")
    files.append_parts(spark, [f"{path}/a", f"{path}/b"], f"{path}/out", file_rows=5000)
    return spark.read.parquet(f"{path}/out")


@query(f"SELECT osm, lon, lat FROM ({L})")
def k2_t6_by_curve(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "k2")
    files.write_by_curve(_left(spark, d).select("osm", "lon", "lat"), path, F.col("lon"), F.col("lat"), 4)
    return spark.read.parquet(path)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def k5_spill(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "k5")
    keep = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    files.spill(table(spark, d, "lineitem"), keep, ["l_orderkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], path)
    return spark.read.parquet(path)


@query("SELECT s_suppkey, s_name, CASE WHEN s_nationkey = 4 THEN 0.0 ELSE s_acctbal END AS s_acctbal, s_nationkey = 4 AS pinned FROM supplier")
def k6_rewrite(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "k6")
    table(spark, d, "supplier").write.parquet(path)
    four = F.col("s_nationkey") == 4
    files.rewrite(spark, path, lambda df: df.withColumns({"s_acctbal": F.when(four, 0.0).otherwise(F.col("s_acctbal")), "pinned": four}))
    return spark.read.parquet(path).select("s_suppkey", "s_name", "s_acctbal", "pinned")


@query("""WITH c AS (SELECT p_type AS a, p_brand AS b, count(*) AS n FROM part GROUP BY 1, 2), g AS (SELECT a, sum(n)::BIGINT AS n, '{"name":"' || a || '","count":' || sum(n)::BIGINT::VARCHAR || ',"children":[' || string_agg('{"name":"' || b || '","count":' || n::VARCHAR || '}', ',' ORDER BY n DESC, b) || ']}' AS j FROM c GROUP BY a)
 SELECT '[' || string_agg(j, ',' ORDER BY n DESC, a) || ']' AS json FROM g""")
def k8_category_tree(spark: SparkSession, d: str) -> DataFrame:
    return files.category_tree(table(spark, d, "part"), ["p_type", "p_brand"])
