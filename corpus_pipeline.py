"""A corpus pipeline of five stages: each reads what the one before kept, as Parquet, and its decisions take effect.

Toxic documents go; one document of each near-duplicate component stays (the one with the smallest id); documents that hold a benchmark item go;
secrets are replaced by a mark; what remains is packed into token sequences. Rows of equal id and text are one document, and one of them stays,
that with the least other columns. Rows whose id is null or belongs to several rows are told apart by their text; in a component they come after those with an id of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm import decontaminate, jaccard_join, packing, secrets, toxicity
from atlasmill.llm.workspace import Workspace, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.train(spark, docs, table(spark, sf_dir, "labels"))
    return toxicity.score(spark, docs, machine).where("score < 0.5").drop("score")


def _keyed(ws: Workspace, docs: DataFrame) -> DataFrame:
    """docs with a key for each document: its id, or for ids that are null or not of one row a hash of id and text above all ids."""
    shared = ws.save(docs.groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_shared")), "shared-ids")
    hashed = F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62))
    return docs.join(shared, docs.doc_id.eqNullSafe(shared._id), "left").withColumn("_key", F.when(F.col("_shared"), hashed).otherwise(F.col("doc_id").cast("long"))).drop("_id")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "jaccard-stage")
    keyed = _keyed(ws, docs)
    found = jaccard_join.jaccard_components(spark, keyed.select("_key", "text"), id_col="_key")
    gone = ws.save(found.where("component_id <> _key").select("_key").distinct(), "gone")
    kept = keyed.join(gone, "_key", "left_anti")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    once = kept.where("_shared").groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("_rest")).select("doc_id", "text", *(F.col("_rest")[c].alias(c) for c in rest)) if rest else kept.where("_shared").select("doc_id", "text").distinct()
    return kept.where("_shared IS NULL").select(docs.columns).unionByName(once.select(docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "decontamination-stage")
    keyed = _keyed(ws, docs)
    leaks = decontaminate.find_leaks(spark, keyed.select("_key", "text"), table(spark, sf_dir, "benchmark"), id_col="_key")
    return keyed.join(ws.save(leaks.select("_key").distinct(), "leaks"), "_key", "left_anti").select(docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(spark, docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express none of the first stage's model, so the whole is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
