"""SparkSession with the settings the operators assume: UTC, Arrow, adaptive execution."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, partitions: int | None = None, name: str = "atlasmill") -> SparkSession:
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    b = b.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, spark.checkpoint.dir; a temporary one only on a local master where that is unset, as in tests."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="atlasmill-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def prepare(spark: SparkSession) -> None:
    """Executors' Python finds this package where the driver found it, if no PYTHONPATH says so."""
    from pathlib import Path

    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH")]))
