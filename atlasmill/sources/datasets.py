"""Published datasets in folders by value, and the XML diffs of a change feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from atlasmill.functions.numeric import geohash


def write_partitioned(rows: DataFrame, path: str, by: str, order: str, keep_order: bool = True, parts: int | None = None) -> None:
    """A folder by=value for each value, its files sorted by `order`; rows without a value are left out.

    Rows are dealt by ranges of (value, order), so a value with many rows gets several files, in order, by as many tasks.
    """
    rows = rows.where(F.col(by).isNotNull())
    dealt = rows.repartitionByRange(parts, by, order) if parts else rows.repartitionByRange(by, order)
    dealt = dealt.sortWithinPartitions(by, order)
    (dealt if keep_order else dealt.drop(order)).write.mode("overwrite").partitionBy(by).parquet(path)


def write_by_place(rows: DataFrame, path: str, lon: str = "lon", lat: str = "lat", prefix: int = 2, parts: int | None = None) -> None:
    """A folder geohash_prefix=xx for each, sorted by the full geohash, which is not kept; rows without a place are left out."""
    told = rows.withColumn("geohash_sort", geohash(F.col(lon), F.col(lat))).withColumn("geohash_prefix", F.substring("geohash_sort", 1, prefix))
    write_partitioned(told, path, "geohash_prefix", "geohash_sort", False, parts)


def read_partitioned(spark: SparkSession, path: str, value: str | None = None, by: str | None = None) -> DataFrame:
    """The dataset, or one value's folder of it. With `by`, its values stay text, such as 01 and 1e."""
    df = spark.read.parquet(path)
    if by:
        df = spark.read.schema(StructType([StructField(f.name, StringType()) if f.name == by else f for f in df.schema])).parquet(path)
    return df.where(F.col(by) == value) if by and value is not None else df


TAGS = "tag ARRAY<STRUCT<_k: STRING, _v: STRING>>"
ELEMENT = f"ARRAY<STRUCT<_id: BIGINT, _version: BIGINT, _timestamp: STRING, _lat: STRING, _lon: STRING, {TAGS}>>"
KINDS = ("node", "way", "relation")


def read_diffs(spark: SparkSession, path: str) -> DataFrame:
    """(seq, type, id, version, timestamp, deleted, lat, lon, tags) of diff files named by their sequence number, gzip or plain.

    Kept: deletions, elements with tags, and those of a version above 1.
    """
    parts = []
    for action in ("create", "modify", "delete"):
        rows = spark.read.format("xml").option("rowTag", action).schema(", ".join(f"{k} {ELEMENT}" for k in KINDS)).load(path)
        rows = rows.withColumn("seq", F.regexp_extract(F.input_file_name(), r"(\d+)\.os[cm][^/]*$", 1).try_cast("long"))
        for kind in KINDS:
            parts.append(rows.select("seq", F.lit(kind).alias("type"), F.explode(kind).alias("e"), F.lit(action == "delete").alias("deleted")))
    tags = F.coalesce(F.transform("e.tag", lambda t: F.struct(t["_k"].alias("k"), t["_v"].alias("v"))), F.array().cast("array<struct<k:string,v:string>>"))
    out = reduce(DataFrame.unionByName, parts).select("seq", "type", F.col("e._id").alias("id"), F.col("e._version").alias("version"), F.col("e._timestamp").alias("timestamp"), "deleted", F.col("e._lat").alias("lat"), F.col("e._lon").alias("lon"), tags.alias("tags"))
    return out.where(F.col("deleted") | (F.size("tags") > 0) | (F.col("version") > 1))
