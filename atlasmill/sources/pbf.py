"""Map elements in protocol buffers: files are cut into their blobs by one task each, and the blobs, of at most 32 MB, are decoded by all.

A file must fit into one value of Spark's binary files, 2 GB; larger extracts come as several files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.operators.lookup import tag_diff

ELEMENT = "type string, id long, version long, timestamp long, visible boolean, lat double, lon double, tags map<string,string>, refs array<long>"
_KINDS = ("node", "way", "relation")


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        x = b[i]
        i += 1
        out |= (x & 127) << shift
        if x < 128:
            return out, i
        shift += 7


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message: varints as numbers, what has a length as bytes."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        match key & 7:
            case 0:
                v, i = _varint(b, i)
            case 2:
                n, i = _varint(b, i)
                v, i = b[i : i + n], i + n
            case 1:
                v, i = b[i : i + 8], i + 8
            case 5:
                v, i = b[i : i + 4], i + 4
            case other:
                raise ValueError(f"wire type {other}")
        yield key >> 3, v


def packed(b: bytes) -> list[int]:
    out, i = [], 0
    while i < len(b):
        v, i = _varint(b, i)
        out.append(v)
    return out


def signed(v: int) -> int:
    """Zigzag."""
    return (v >> 1) ^ -(v & 1)


def running(values: list[int]) -> list[int]:
    out, at = [], 0
    for v in values:
        at += signed(v)
        out.append(at)
    return out


def blobs(data: bytes) -> Iterator[bytes]:
    """Data blobs of a file, as they are stored."""
    i = 0
    while i < len(data):
        (n,) = struct.unpack_from(">I", data, i)
        head = dict(fields(data[i + 4 : i + 4 + n]))
        i += 4 + n
        if head[1] == b"OSMData":
            yield data[i : i + head[3]]
        i += head[3]


def elements(blob: bytes) -> Iterator[tuple]:
    """(type, id, version, milliseconds, visible, lat, lon, tags, refs) of a blob; what it doesn't tell is None, visible is true."""
    body = dict(fields(blob))
    block = body[1] if 1 in body else zlib.decompress(body[3])
    texts, groups, scale = [], [], {17: 100, 18: 1000, 19: 0, 20: 0}
    for k, v in fields(block):
        if k == 1:
            texts = [s.decode("utf-8", "replace") for _, s in fields(v)]
        elif k == 2:
            groups.append(v)
        elif k in scale:
            scale[k] = v
    place = lambda raw, offset: (scale[offset] + scale[17] * raw) * 1e-9
    for group in groups:
        for kind, v in fields(group):
            if kind == 2:
                yield from _dense(dict(fields(v)), texts, scale, place)
            elif kind in (1, 3, 4):
                m = dict(fields(v))
                info = dict(fields(m.get(4, b"")))
                tags = {texts[a]: texts[b] for a, b in zip(packed(m.get(2, b"")), packed(m.get(3, b"")), strict=True)}
                at = (place(signed(m[8]), 19), place(signed(m[9]), 20)) if kind == 1 else (None, None)
                refs = [] if kind == 1 else running(packed(m.get({3: 8, 4: 9}[kind], b"")))
                stamp = info[2] * scale[18] if 2 in info else None
                yield (_KINDS[max(0, kind - 2)], signed(m[1]) if kind == 1 else m[1], info.get(1), stamp, bool(info.get(6, 1)), *at, tags, refs)


def _dense(m: dict, texts: list[str], scale: dict, place) -> Iterator[tuple]:
    ids = running(packed(m[1]))
    info = dict(fields(m.get(5, b"")))
    versions = packed(info[1]) if 1 in info else [None] * len(ids)
    stamps = [t * scale[18] for t in running(packed(info[2]))] if 2 in info else [None] * len(ids)
    shown = packed(info[6]) if 6 in info else [1] * len(ids)
    pairs, i = packed(m.get(10, b"")), 0
    for n, version, stamp, on, lat, lon in zip(ids, versions, stamps, shown, running(packed(m[8])), running(packed(m[9])), strict=True):
        tags = {}
        while i < len(pairs) and pairs[i]:
            tags[texts[pairs[i]]] = texts[pairs[i + 1]]
            i += 2
        i += 1
        yield "node", n, version, stamp, bool(on), place(lat, 19), place(lon, 20), tags, []


def read_pbf(spark: SparkSession, path: str, parts: int | None = None) -> DataFrame:
    """Rows of ELEMENT; timestamp as a timestamp. A snapshot's elements, or all versions of a full history."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("content"):
                for blob in blobs(x.as_py()):
                    yield pa.record_batch({"blob": pa.array([blob], pa.binary())})

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.float64(), pa.map_(pa.string(), pa.string()), pa.list_(pa.int64())]
        names = ["type", "id", "version", "timestamp", "visible", "lat", "lon", "tags", "refs"]
        for b in batches:
            for x in b.column("blob"):
                cols = list(zip(*elements(x.as_py()), strict=True)) or [()] * 9
                cols[7] = [list(t.items()) for t in cols[7]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    dealt = files.mapInArrow(cut, "blob binary")
    dealt = dealt.repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInArrow(decode, ELEMENT).withColumn("timestamp", F.timestamp_millis("timestamp"))


def changes(versions: DataFrame) -> DataFrame:
    """(type, id, version, timestamp, key, value, change): what each version of an element did to its tags; a deletion takes them all."""
    w = Window.partitionBy("type", "id").orderBy("version")
    shown = F.when(F.col("visible"), F.col("tags"))
    told = versions.withColumn("_d", tag_diff(F.lag(shown).over(w), shown))
    return told.select("type", "id", "version", "timestamp", F.explode("_d").alias("d")).select("type", "id", "version", "timestamp", "d.*")


def tagged_places(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Visible elements that have any of the keys, with a place: a node's own, a way's mean of its nodes, the closing one once."""
    nodes = rows.where("type = 'node' AND visible").select(F.col("id").alias("ref"), F.col("lat").alias("_y"), F.col("lon").alias("_x"))
    kept = rows.where(F.col("visible") & F.exists(F.map_keys("tags"), lambda k: k.isin(keys)))
    corners = kept.where("type = 'way'").select("id", F.explode(F.array_distinct("refs")).alias("ref")).join(nodes, "ref").groupBy("id").agg(F.avg("_y").alias("lat"), F.avg("_x").alias("lon"))
    ways = kept.where("type = 'way'").drop("lat", "lon").join(corners, "id")
    return kept.where("type = 'node'").select("type", "id", "tags", "lat", "lon").unionByName(ways.select("type", "id", "tags", "lat", "lon"))
