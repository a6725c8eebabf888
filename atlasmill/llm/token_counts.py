"""Token counts without identifiers: heap-and-linked-list byte-pair merging, initial symbols less merges.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows are counted each; a null id stays null;
other columns are ignored. Strings of special tokens inside a text count one each, as the tokenizers library does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm import bpe
from atlasmill.llm.workspace import prepare, table

_parts: dict[str, bpe.Parts] = {}


def counter(path: str) -> bpe.Parts:
    if path not in _parts:
        v = bpe.vocabulary(path)
        _parts[path] = bpe.Parts(v, v.count, sum)
    return _parts[path]


def count_tokens(spark: SparkSession, docs: DataFrame, vocab_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row's whole text. vocab_path: a byte-level BPE file, there on every executor."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = counter(vocab_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = pa.array([sum(parts.values(t)) if t else 0 for t in texts], pa.int64())
            size = pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int64())
            yield pa.record_batch({"id": batch.column("id"), "n_bytes": size, "n_tokens": n})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
