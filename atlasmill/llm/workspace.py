"""Where operators put tables that cut lineage, and how their code reaches the executors' Python."""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

REPO = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Executors' Python finds this package where the driver found it, if no PYTHONPATH says so."""
    env = spark.sparkContext.environment
    if REPO not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = ":".join(filter(None, [REPO, env.get("PYTHONPATH")]))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only on a local master where that is unset, as in tests."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="atlasmill-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Workspace:
    """Written tables of one run of an operator. They survive lost executors; drop() frees one that is not read again."""

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:02d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._atlasmill_path = path
        return out

    def drop(self, *saved: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in saved:
            path = jvm.org.apache.hadoop.fs.Path(df._atlasmill_path)
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
