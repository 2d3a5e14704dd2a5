"""Feeds that arrive out of order: changes wait until the clock has passed them.

A change carries ``at``, the time it was made; ``at`` never falls as ``seq`` grows. The latest ``at``
that the stream has seen is its clock. A change leaves once the clock is ``bound`` beyond it, so whatever comes
up to ``bound`` late still finds its place. What comes later than that is reported and not applied.
A row without ``op`` is no change: it only moves the clock, as at the end of a feed.

What waits is kept beside the stream's checkpoint, as files: each micro-batch stores what arrived in it once, with a
note of the clock after it. What leaves is a range of time between two clocks, which all arrivals that may
still hold such rows are read for; folders that the clock has passed whole are not read any more.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sitewise.operators.maintain import QUARANTINE
from sitewise.rules import Rule
from sitewise.schema import CHANGES
from sitewise.session import exists, remove
from sitewise.sources.tables import Tables
from sitewise.streaming.feed import apply_once

TIMED = T.StructType([*CHANGES.fields, T.StructField("at", T.TimestampType())])
_LATE = "late"
# Milliseconds: the clock after a batch, and the first and last ``at`` of the changes that arrived in it.
_NOTE = "batch bigint, clock bigint, low bigint, high bigint"


def read_timed_feed(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A folder of files of timed changes as a stream."""
    return spark.readStream.schema(TIMED).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clock_rows(spark: SparkSession, at: dt.datetime, n: int = 1) -> DataFrame:
    """Rows that only move the clock, each in a partition, and so a file, of its own."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in CHANGES.fields]
    return spark.range(0, n, 1, n).select(*nothing, F.lit(at).alias("at"))


def _ms(at: str) -> Column:
    return F.unix_millis(at)


def arrive(changes: DataFrame, batch_id: int, home: str, bound: dt.timedelta) -> tuple[DataFrame, DataFrame]:
    """Stores a micro-batch under ``home``; gives the changes that came too late and those that the clock has now passed.

    A batch that is run again, the last one always, replaces what it had stored and gives the same rows.
    """
    spark, wait = changes.sparkSession, int(bound.total_seconds() * 1000)
    stored, notes = f"{home}/arrived/batch={batch_id}", f"{home}/notes"
    changes.select(*TIMED.names).write.mode("overwrite").parquet(stored)
    rows = spark.read.schema(TIMED).parquet(stored)
    is_change = F.col("op").isNotNull()
    clock, low, high, timeless = rows.agg(
        F.max(_ms("at")), F.min(F.when(is_change, _ms("at"))), F.max(F.when(is_change, _ms("at"))), F.count_if(is_change & F.col("at").isNull())
    ).first()
    if timeless:
        raise ValueError(f"batch {batch_id} holds {timeless} changes without a time")
    held = []
    if exists(spark, notes):
        held = spark.read.schema(_NOTE).option("recursiveFileLookup", True).parquet(notes).where(F.col("batch") < batch_id).collect()
    before = max((n["clock"] for n in held if n["clock"] is not None), default=None)
    now = max((c for c in (before, clock) if c is not None), default=None)
    note = spark.createDataFrame([(batch_id, now, low, high)], _NOTE)
    note.coalesce(1).write.mode("overwrite").parquet(f"{notes}/batch={batch_id}")

    passed = lambda then: F.lit(False) if then is None else _ms("at") + wait <= then
    late = rows.where(is_change & passed(before))
    # Of a batch that the clock had passed before, nothing is left but what was late.
    open_to = [n["batch"] for n in held if n["high"] is not None and (before is None or n["high"] + wait > before)]
    spent = [n["batch"] for n in held if n["batch"] not in open_to]
    folders = [f"{home}/arrived/batch={n}" for n in sorted(open_to)] + [stored]
    due = spark.read.schema(TIMED).parquet(*folders).where(is_change & passed(now) & ~passed(before))
    for n in spent:
        if n < batch_id - 1:  # the batch before may still be run again
            remove(spark, f"{home}/arrived/batch={n}")
    return late, due


def stream_apply_ordered(
    stream: DataFrame, root: str, tables: Tables, rule: Rule, checkpoint: str, bound: dt.timedelta, on_reject: str = QUARANTINE, whole_every: int = 50
) -> StreamingQuery:
    """``stream_apply`` for timed changes that arrive out of order, ``bound`` late at most.

    Later ones are kept under ``root/late``, by micro-batch, and are not applied.
    """

    def apply(changes: DataFrame, batch_id: int) -> None:
        late, due = arrive(changes, batch_id, f"{checkpoint}/waiting", bound)
        late.write.mode("overwrite").parquet(f"{root}/{_LATE}/batch={batch_id}")
        due = due.drop("at")
        if not due.isEmpty():
            apply_once(due, batch_id, root, tables, rule, checkpoint, on_reject, whole_every)

    return (
        stream.writeStream.foreachBatch(apply)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_changes(spark: SparkSession, root: str) -> DataFrame:
    """What came too late to be applied."""
    return spark.read.schema(TIMED).parquet(f"{root}/{_LATE}").select(*TIMED.names)
