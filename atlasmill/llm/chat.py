"""Chat formatting by perspective rotation: each participant in turn is the assistant, the others are named users.

A conversation is rendered once for every participant whose turns it has (system turns keep their role and are no participant). A
result row is one rendered turn in one perspective, with its place in that rendering and the mask: loss falls on what the perspective's
own speaker said and on the mark that ends it. Places are running sums in two levels, inside blocks of turns and over blocks, so that a conversation of
any length is spread over tasks.

Defined results: a null text renders as empty; a null role is a speaker named "unknown"; rows without a conversation id form one
conversation with a null id; turns of equal number are ordered by role and text, null turns come first; repeated rows are
rendered each; a conversation of system turns alone has no perspective and no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.llm.workspace import table

HEAD, TAIL, TURNS = "<|{role}|>\n", "<|end|>\n", 256


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, perspective, turn, speaker, role, segment, start, end, mask_start, mask_end, loss) for each turn and participant.

    start and end are code points in the rendering of (conv, perspective); loss covers [mask_start, mask_end) where it is true.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("speaker"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    who = rows.where("speaker <> 'system'").select(F.col("conv").alias("c"), F.col("speaker").alias("perspective")).distinct()
    each = rows.join(who, rows.conv.eqNullSafe(who.c)).drop("c")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == "system", F.lit("system")).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), F.col("speaker")))
    head = F.concat(F.lit(HEAD.partition("{")[0]), role, F.lit(HEAD.partition("}")[2]))
    each = each.select("conv", "perspective", "turn", "speaker", role.alias("role"), F.concat(head, "text", F.lit(TAIL)).alias("segment"), F.char_length(head).alias("head"), own.alias("loss"))
    each = each.withColumn("n", F.char_length("segment").cast("long")).withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / TURNS))
    order = [F.col("turn").asc_nulls_first(), "speaker", "segment"]
    inside = Window.partitionBy("conv", "perspective", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = each.groupBy("conv", "perspective", "block").agg(F.sum("n").alias("n"))
    over = Window.partitionBy("conv", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("conv").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    placed = each.withColumn("end", F.sum("n").over(inside))
    placed = placed.join(before, placed.conv.eqNullSafe(before.c) & (placed.perspective == before.p) & (placed.block == before.b))
    end = F.col("end") + F.col("before")
    out = placed.select(F.col("conv").alias(conv_col), "perspective", F.col("turn").alias(turn_col), "speaker", "role", "segment", (end - F.col("n")).alias("start"), end.alias("end"), (end - F.col("n") + F.col("head")).alias("mask_start"), "loss")
    return out.withColumn("mask_end", F.col("end") - 1)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


SQL = """
WITH t AS (SELECT conv_id AS conv, turn::BIGINT AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
w AS (SELECT DISTINCT conv AS c, speaker AS perspective FROM t WHERE speaker <> 'system'),
e AS (SELECT conv, perspective, turn, speaker, speaker = perspective AS loss, text,
        CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user name=' || speaker END AS role
      FROM t JOIN w ON t.conv IS NOT DISTINCT FROM w.c),
s AS (SELECT *, '<|' || role || '|>' || chr(10) AS head, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS segment FROM e),
p AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv, perspective ORDER BY turn NULLS FIRST, speaker, segment ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM s)
SELECT conv AS conv_id, perspective, turn, speaker, role, segment, stop - length(segment) AS start, stop AS "end",
  stop - length(segment) + length(head) AS mask_start, loss, stop - 1 AS mask_end FROM p
"""
