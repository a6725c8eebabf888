"""I-Match document fingerprints, in DataFrame functions only.

A term is a run of letters and digits of the lower-cased text. The lexicon holds the terms whose document frequency lies in a
band [least, most] as shares of all documents (an inverse-document-frequency band); it has at most mean distinct terms / least
entries, whatever the input, so it is broadcast. A random hash deals the lexicon into SUBSETS subsets; a fingerprint lists, for each subset that
the text has terms of, the hash of those terms (distinct; the hash does not depend on their order, which stands for sorting them).
Likeness is the share of (subset, hash) entries that two fingerprints have in common, of all that either has. A text without
a lexicon term gets one entry, the hash of the text.

The next document is found without a global sort: ids are cut into ranges at quantiles, each range also holds a copy of the first
row of the range after it, and lead() runs inside ranges. The text is shuffled once; fingerprints are made where it lies.

Defined results: null texts count as empty; null ids come first; rows of equal id are ordered by a hash of the text; a single row is
followed by itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.llm.workspace import partitions, table

SUBSETS, LEAST, MOST = 128, 1 / 1000, 1 / 100
_MARK = 0  # stands for "this text was here", in every list of terms and in the lexicon


def terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.xxhash64(t)))


def lexicon(rows: DataFrame, least: float, most: float, n: int) -> DataFrame:
    empty = F.xxhash64(F.lit(""))
    df = rows.select(F.explode(terms("text")).alias("term")).where(F.col("term") != empty).groupBy("term").agg(F.count("*").alias("df"))
    low = max(2.0, least * n)
    return df.where(F.col("df").between(low, max(low, most * n))).select("term")


def fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, most: float = MOST, subsets: int = SUBSETS) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranges = 2 * partitions(spark)
    told = rows.agg(F.count("*").alias("n"), F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("cuts")).first()
    cuts = F.array(*[F.lit(c).cast("long") for c in sorted(set(told["cuts"] or []))]) if told["cuts"] else F.array().cast("array<bigint>")
    rows = rows.withColumn("part", F.size(F.filter(cuts, lambda c: c <= F.col("id"))))

    first = rows.groupBy("part").agg(F.min("id").alias("id"), F.max(F.col("id").isNull()).alias("nulls"))
    first = first.select(F.col("part").alias("p"), F.when(~F.col("nulls"), F.col("id")).alias("i"))
    first = rows.join(F.broadcast(first), F.expr("part = p AND id <=> i")).groupBy("part").agg(F.min(F.struct(F.xxhash64("text"), "text", "id")).alias("row"))
    order = Window.orderBy("part")  # one row a range
    ghost = first.select(F.coalesce(F.lag("part").over(order), F.max("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("part"), F.col("row.id").alias("id"), F.col("row.text").alias("text"), F.lit(1).alias("ghost"))
    both = rows.withColumn("ghost", F.lit(0)).unionByName(ghost)

    here = Window.partitionBy("part").orderBy("ghost", F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")
    n, k = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    held = both.select("part", "ghost", "id", F.row_number().over(here).alias("rn"), "text", F.lead("text").over(here).alias("next"))
    held = held.select("part", "ghost", "id", "rn", "text", n.cast("long").alias("n_chars"), F.when(F.col("ghost") == 0, F.concat(F.substring("text", F.lit(1), n - k), F.substring("next", F.lit(1), k))).alias("edited"))

    bodies = held.select("part", "rn", F.explode(F.filter(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body"))), lambda b: b.body.isNotNull())).alias("b"))
    found = bodies.select("part", "rn", F.col("b.kind").alias("kind"), F.xxhash64("b.body").alias("whole"), F.explode(F.concat(F.array(F.lit(_MARK).cast("long")), terms(F.col("b.body")))).alias("term"))
    words = lexicon(rows, least, most, told["n"]).unionByName(spark.range(1).select(F.lit(_MARK).cast("long").alias("term")))
    found = found.join(F.broadcast(words), "term", "left_semi")
    subset = F.when(F.col("term") == _MARK, -1).otherwise(F.pmod(F.xxhash64("term", F.lit(17)), F.lit(subsets))).cast("int")
    found = found.groupBy("part", "rn", "kind", subset.alias("subset")).agg(F.bit_xor(F.xxhash64("term", F.lit(29))).alias("h"), F.max("whole").alias("whole"))
    entry = F.format_string("%02x%08x", F.col("subset"), F.col("h").bitwiseAND(0xFFFFFFFF))
    entries = [F.collect_list(F.when((F.col("kind") == i) & (F.col("subset") >= 0), entry)).alias(f"f{i}") for i in (0, 1)]
    whole = [F.max(F.when(F.col("kind") == i, F.lower(F.hex("whole")))).alias(f"w{i}") for i in (0, 1)]
    prints = found.groupBy("part", "rn").agg(*entries, *whole)
    prints = prints.select("part", "rn", *[F.when(F.size(f"f{i}") > 0, F.sort_array(f"f{i}")).otherwise(F.array(F.concat(F.lit("whole"), F.col(f"w{i}")))).alias(f"f{i}") for i in (0, 1)])
    prints = prints.withColumn("f2", F.lead("f0").over(Window.partitionBy("part").orderBy("rn")))
    alike = lambda a, b: F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    prints = prints.select("part", "rn", F.array_join("f0", ".").alias("fingerprint"), F.array_join("f1", ".").alias("edited_fingerprint"), alike("f0", "f1").alias("near_edited"), alike("f0", "f2").alias("near_next"))

    base = held.where("ghost = 0").select("part", "rn", "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    return base.join(prints, ["part", "rn"]).select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark, table(spark, sf_dir, "documents"))
