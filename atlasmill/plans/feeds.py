"""Streams, published datasets and checks between releases, on stand-ins derived from the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.operators import releases
from atlasmill.plans.domain import d14_observations
from atlasmill.plans.registry import SQL, query
from atlasmill.session import shared_folder, table
from atlasmill.sources import datasets
from atlasmill.streaming import feed


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query("SELECT DISTINCT user_id, event_id FROM events")
def st1_roll(spark: SparkSession, d: str) -> DataFrame:
    rows = feed.read(spark, f"{d}/events.parquet").select("user_id", "event_id")
    return feed.drain(feed.roll(rows, ["user_id"], "event_id"), _folder(spark, "st1"))


@query(SQL[d14_observations.__name__])
def st5_observe(spark: SparkSession, d: str) -> DataFrame:
    flags = [(F.col("event_type") == t).alias(c) for t, c in (("signup", "added"), ("error", "deleted"), ("view", "closed"), ("click", "reopened"))]
    rows = feed.read(spark, f"{d}/events.parquet").select("event_id", "user_id", "ts", F.round("value", 2).cast("string").alias("value"), *flags)
    return feed.drain(feed.observe(rows, "user_id", "event_id", "ts"), _folder(spark, "st5")).select("event_id", "tag_value", "changed", "last_at")


@query("""SELECT epoch_us(s)::BIGINT AS start_us, event_type, n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, event_type, count(*) AS n FROM events GROUP BY 1, 2)
 WHERE s + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY FROM events)""")
def st6_window_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = feed.read(spark, f"{d}/events.parquet").select("ts", "event_type")
    out = feed.drain(feed.window_counts(rows, "ts", "1 hour", "2 days", "event_type"), _folder(spark, "st6"))
    return out.select(F.unix_micros("start").alias("start_us"), "event_type", "n")


@query("""SELECT user_id, after, event_id AS before FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS after FROM (SELECT DISTINCT user_id, event_id FROM events)) WHERE event_id - after > 1""")
def st2_gaps(spark: SparkSession, d: str) -> DataFrame:
    return feed.gaps(table(spark, d, "events"), "event_id", "user_id")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL")
def k4_s3_partitioned(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "k4")
    datasets.write_partitioned(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), path, "o_orderpriority", "o_orderkey")
    return datasets.read_partitioned(spark, path)


@query("""SELECT c_custkey AS id, round(-122.45 + ((c_custkey * 7919) % 10007) * 0.02::DOUBLE, 6) AS lon, round(20 + ((c_custkey * 5641) % 10009) * 0.002::DOUBLE, 6) AS lat FROM customer""")
def k3_by_place(spark: SparkSession, d: str) -> DataFrame:
    lon, lat = -122.45 + F.col("c_custkey") * 7919 % 10007 * 0.02, 20 + F.col("c_custkey") * 5641 % 10009 * 0.002
    path = _folder(spark, "k3")
    datasets.write_by_place(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), lon.alias("lon"), lat.alias("lat")), path)
    return datasets.read_partitioned(spark, path).select("id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("""WITH h AS (SELECT user_id AS id, max(ts) AS at, arg_max(event_type, (ts, event_id)) AS name FROM events GROUP BY 1), s AS (SELECT c_custkey AS id, TIMESTAMP '2100-01-01' AS edited, 'view' AS name FROM customer WHERE c_nationkey < 5 UNION ALL SELECT c_custkey, (SELECT max(ts) FROM events e WHERE e.user_id = c_custkey), c_mktsegment FROM customer WHERE c_nationkey >= 5)
 SELECT count(*) AS n, count(h.id) AS found, count(*) FILTER (WHERE h.at = s.edited) AS same_time, count(*) FILTER (WHERE h.name = s.name) AS same_name FROM s LEFT JOIN h ON s.id = h.id WHERE s.edited < TIMESTAMP '2099-01-01'""")
def d19_history_check(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("id"), F.col("ts").alias("at"), "event_id", F.col("event_type").alias("name"))
    last = e.groupBy("id").agg(F.max("at").alias("last"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", "c_mktsegment").join(last, "id", "left")
    young = F.col("c_nationkey") < 5
    shot = c.select("id", F.when(young, F.lit("2100-01-01").cast(e.schema["at"].dataType)).otherwise(F.col("last")).alias("edited"), F.when(young, "view").otherwise(F.col("c_mktsegment")).alias("name"))
    return releases.history_check(e, shot, "id", ["at", "event_id"], F.lit("2099-01-01").cast("timestamp"))


@query("""WITH a AS (SELECT o_orderkey AS k, 'v0-' || o_custkey::VARCHAR AS id FROM orders), b AS (SELECT o_orderkey AS k, 'v1-' || o_custkey::VARCHAR AS id FROM orders WHERE o_orderstatus <> 'P')
 SELECT DISTINCT a.id AS old_id, b.id AS new_id FROM a JOIN b USING (k)""")
def d21_migration(spark: SparkSession, d: str) -> DataFrame:
    ids = lambda v: F.concat(F.lit(v), F.col("o_custkey").cast("string")).alias("unified_id")
    o = table(spark, d, "orders")
    return releases.migration(o.select(F.col("o_orderkey").alias("source_key"), ids("v0-")), o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("source_key"), ids("v1-")))
