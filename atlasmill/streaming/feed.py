"""A change feed as a stream: its continuity, roll-forward, the state of tags along versions, and counts with a watermark.

Per-key state is a few values, whatever the length of the feed. Of a micro-batch, a key's rows are sorted in one task, so the size of a
micro-batch (maxFilesPerTrigger of the source) bounds what a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


class FeedGap(RuntimeError):
    """A sequence number that the feed should hold is missing."""


def require_sequence(feed: DataFrame, seq: str, last: int | None = None) -> None:
    """Raises if numbers after `last` (the last one used; None: the first there is) have a gap. Repeats are no gap."""
    known = feed.select(F.col(seq).cast("long").alias("s")).where("s IS NOT NULL" if last is None else f"s > {int(last)}").distinct()
    told = known.agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.count("*").alias("n")).first()
    if told["n"] and (told["hi"] - told["lo"] + 1 != told["n"] or (last is not None and told["lo"] != last + 1)):
        raise FeedGap(f"{told['n']} of the numbers from {told['lo'] if last is None else last + 1} to {told['hi']}")


def require_chain(built: date, today: date, months: int = 12) -> None:
    """Raises when a chain of roll-forwards is older than so many months, so that a full build is due."""
    if (today.year - built.year) * 12 + today.month - built.month - (today.day < built.day) >= months:
        raise FeedGap(f"last full build {built}, more than {months} months before {today}")


def read(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A Parquet folder or file as a stream; at most so many files a micro-batch."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    return (r.option("maxFilesPerTrigger", files) if files else r).parquet(path + "*")


def drain(stream: DataFrame, folder: str) -> DataFrame:
    """Runs a stream over all there is, resumably and exactly once, into `folder`; the rows written so far."""
    run = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start(f"{folder}/rows")
    run.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def roll(stream: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows whose version is above all that their keys had before, each once. Rows without a version are skipped."""
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}

    def step(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = state.get[0] if state.exists else None
        held = pd.concat(list(batches)).sort_values(version, kind="stable").drop_duplicates(version)
        fresh = held if known is None else held[held[version] > known]
        if len(fresh):
            state.update((int(fresh[version].iloc[-1]),))
        yield fresh

    schema = ", ".join(f"`{c}` {t}" for c, t in kinds.items())
    return stream.where(F.col(version).isNotNull()).groupBy(*keys).applyInPandasWithState(step, schema, "known long", "append", GroupStateTimeout.NoTimeout)


def observe(stream: DataFrame, entity: str, order: str, at: str) -> DataFrame:
    """The state of a tag along each entity's versions, as history.observations gives it, as versions arrive in order.

    stream: entity (long), order (long), at (timestamp), added, deleted, closed, reopened, value. Out: entity, order, tag_value, changed, last_at.
    """
    flags = ("added", "deleted", "closed", "reopened")
    rows = stream.select(F.col(entity).cast("long").alias(entity), F.col(order).cast("long").alias(order), F.unix_micros(F.col(at).cast("timestamp")).alias("_at"), *[F.coalesce(f, F.lit(False)).alias(f) for f in flags], F.col("value").cast("string"))

    def step(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        is_open, held, value, last = state.get if state.exists else (False, None, None, None)
        rows = pd.concat(list(batches)).sort_values(["_at", order])
        out = []
        for e, n, t, added, deleted, closed, reopened, new in rows.itertuples(index=False):
            is_open = is_open or added
            if not is_open:
                continue
            if added and isinstance(new, str):
                held = new
            down = deleted or closed
            if added or (reopened and not down):
                value = held
            elif down:
                value = None
            out.append((e, n, value, int(added or down or reopened), last))
            last = None if pd.isna(t) else int(t)
        state.update((bool(is_open), held, value, last))
        told = pd.DataFrame(out, columns=[entity, order, "tag_value", "changed", "last"])
        yield told.astype({"last": "Int64", "tag_value": object})

    out = rows.groupBy(entity).applyInPandasWithState(step, f"`{entity}` long, `{order}` long, tag_value string, changed int, last long", "open boolean, held string, value string, last long", "append", GroupStateTimeout.NoTimeout)
    return out.select(entity, order, "tag_value", "changed", F.timestamp_micros("last").cast(stream.schema[at].dataType).alias("last_at"))


def window_counts(stream: DataFrame, at: str, size: str, late: str, *by: str) -> DataFrame:
    """(start, end, by, n) of windows that the watermark has passed; rows later than that are not counted."""
    told = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, size), *by).agg(F.count("*").alias("n"))
    return told.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def recent(rows: DataFrame, at: str, now: Column, years: int = 3) -> DataFrame:
    """Events of the last so many years; as a stream, those later than that behind the newest go."""
    if rows.isStreaming:
        rows = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, f"{years * 365} days")
    return rows.where(F.col(at) >= now - F.expr(f"INTERVAL {years} YEARS"))


def first_wins(stream: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """Each key once while the watermark lasts: what is delivered again in that time is dropped."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def gaps(feed: DataFrame, seq: str, by: str) -> DataFrame:
    """(by, after, before): numbers around each gap of each feed."""
    w = Window.partitionBy(by).orderBy(seq)
    return feed.select(by, seq).distinct().withColumn("after", F.lag(seq).over(w)).where(F.col(seq) - F.col("after") > 1).select(by, "after", F.col(seq).alias("before"))
