"""Files beside datasets: lookups as text, releases, coverage, bounded and spatially ordered Parquet, rewrites that swap, trees as JSON."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions.geometry import hilbert


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def with_positions(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset with the file and the place in it of each row."""
    df = spark.read.parquet(path)
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def releases(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders under root, sorted; release names sort by date."""
    fs, p = _fs(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def latest_release(spark: SparkSession, root: str, before: str | None = None) -> str:
    names = [n for n in releases(spark, root) if before is None or n < before]
    if not names:
        raise FileNotFoundError(f"no release under {root}")
    return names[-1]


def part_keys(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(suffix))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; all columns are text, nothing is taken for missing, what is missing is empty."""
    return spark.read.csv(path, header=True, inferSchema=False, nullValue="\x00", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).na.fill("")


def read_model(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, of a schema that is checked by name."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def write_csv(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One file, for summaries."""
    (rows.orderBy(*order) if order else rows).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_bounded(rows: DataFrame, path: str, file_rows: int = 5_000_000, group_bytes: int = 64 << 20) -> None:
    """Parquet of files of at most so many rows and row groups of about so many bytes; a task holds one group at a time."""
    rows.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", file_rows).option("parquet.block.size", group_bytes).parquet(path)


def append_parts(spark: SparkSession, paths: list[str], path: str, **how: int) -> None:
    """Parts of unlike columns as one dataset: columns by name, missing ones null, numbers of the widest type."""
    rows = spark.read.parquet(paths[0])
    for p in paths[1:]:
        rows = rows.unionByName(spark.read.parquet(p), allowMissingColumns=True)
    write_bounded(rows, path, **how)


def write_by_curve(rows: DataFrame, path: str, lon: Column, lat: Column, parts: int | None = None) -> None:
    """Files that are ranges of the Hilbert curve, sorted along it; the key isn't kept."""
    told = rows.withColumn("_hilbert", hilbert(lon, lat))
    dealt = told.repartitionByRange(parts, "_hilbert") if parts else told.repartitionByRange("_hilbert")
    write_bounded(dealt.sortWithinPartitions("_hilbert").drop("_hilbert"), path)


def spill(rows: DataFrame, keep: DataFrame, key: list[str], columns: list[str], path: str) -> None:
    """The kept rows' columns; a left semi join moves no row out of its order unless it has to shuffle."""
    write_bounded(rows.join(keep.select(*key).distinct(), key, "left_semi").select(*columns), path)


def rewrite(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """A dataset with changed columns in its place: written beside it, then swapped by renames, so that a failure leaves the old one."""
    fs, here = _fs(spark, path)
    staged, old = (spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + x) for x in (".staged", ".old"))
    fs.delete(staged, True)
    fs.delete(old, True)
    before = spark.read.parquet(path)
    after = change(before)
    lost = set(before.columns) - set(after.columns)
    if lost:
        raise ValueError(f"columns lost: {sorted(lost)}")
    after.select(*before.columns, *[c for c in after.columns if c not in before.columns]).write.option("compression", "zstd").parquet(staged.toString())
    if not (fs.rename(here, old) and fs.rename(staged, here)):
        raise OSError(f"{path} could not be swapped")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """One small JSON file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()


def read_json(spark: SparkSession, path: str) -> dict | None:
    """The value, or None without a file."""
    fs, p = _fs(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if fs.exists(p) else None


def require_full(coverage: dict | None) -> dict:
    """The coverage of a history, if it has one from the start."""
    if not coverage or coverage.get("mode") != "full":
        raise ValueError("the history has no full coverage")
    return coverage


def plan_sequences(stamp: Callable[[int], datetime], after: datetime, until: datetime, last: int) -> range:
    """Numbers of the diffs whose time is after the one and not after the other. stamp: when a diff ends, growing with its number."""

    def first_above(t: datetime) -> int:
        low, high = 0, last + 1
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if stamp(mid) > t else (mid + 1, high)
        return low

    return range(first_above(after), first_above(until))


def head(rows: DataFrame, n: int = 5) -> DataFrame:
    return rows.limit(n)


def sample_keys(rows: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """All rows of a share of the keys, the same ones wherever they are."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")
    return rows.where(h < int(fraction * (1 << 32)))


def category_tree(rows: DataFrame, levels: list[str]) -> DataFrame:
    """(json): nested counts by up to two levels, the most frequent first."""
    a, b = levels
    inner = rows.groupBy(a, b).agg(F.count("*").alias("count")).groupBy(a).agg(F.sum("count").alias("count"), F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("_o"), F.col(b).alias("name"), "count"))).alias("kids"))
    node = F.struct(F.col(a).alias("name"), F.col("count"), F.transform("kids", lambda x: F.struct(x["name"].alias("name"), x["count"].alias("count"))).alias("children"))
    return inner.agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("_o"), F.col(a).alias("_n"), node.alias("node")))), lambda x: x["node"])).alias("json"))


def publish(spark: SparkSession, source: str, target: str) -> None:
    """A copy of a dataset's files at another place, through Hadoop's file systems."""
    fs, p = _fs(spark, source)
    to, q = _fs(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, q, False, True, spark._jsc.hadoopConfiguration())


def pipe_table(columns: list[str], rows: list[tuple]) -> str:
    """Markdown; pipes in cells are escaped, missing ones empty."""
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(columns), "|" + "--|" * len(columns), *map(line, rows)])
