"""Routing and applying a change feed with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitewise.operators.changes import route_changes
from sitewise.operators.fragments import load_sites
from sitewise.operators.maintain import QUARANTINE, decide_batch
from sitewise.rules import NOWHERE, Rule
from sitewise.schema import CHANGES
from sitewise.sources.snapshots import Frags, Note, applied, fragment_write, last_seq, last_version, read_version, write_deltas
from sitewise.sources.tables import Tables

_GLOBAL = "global"
_SITES = "sites"
_REJECTED = "rejected"
_LINES = "lignes_commandes"


def read_feed(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A folder of change files as a stream."""
    return spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_route(stream: DataFrame, products: DataFrame, rule: Rule, sink: str, checkpoint: str) -> StreamingQuery:
    """Site actions of every change, appended to ``sink``. Stateless: a stream-static join."""
    return (
        route_changes(stream, products, rule)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def begin(root: str, tables: Tables, rule: Rule) -> None:
    """Version 0: the global lines and the fragments derived from them, both whole."""
    fragment_write({_LINES: tables[_LINES].withColumn("site", F.lit(NOWHERE))}, f"{root}/{_GLOBAL}", 0)
    load_sites(tables, rule, f"{root}/{_SITES}", 0)


def state(spark: SparkSession, root: str, tables: Tables, version: int | None = None) -> tuple[Tables, Frags]:
    """Global tables and fragments as of a version (the last one by default)."""
    if version is None:
        version = last_version(spark, f"{root}/{_SITES}")
    lines = read_version(spark, f"{root}/{_GLOBAL}", version)[_LINES].drop("site")
    return {**tables, _LINES: lines}, read_version(spark, f"{root}/{_SITES}", version)


def rejected_changes(spark: SparkSession, root: str) -> DataFrame:
    """What all committed batches refused."""
    stored = spark.read.parquet(f"{root}/{_REJECTED}")
    return stored.where(F.col("v") <= last_version(spark, f"{root}/{_SITES}")).drop("v")


def apply_version(
    changes: DataFrame, root: str, tables: Tables, rule: Rule, version: int, on_reject: str = QUARANTINE, note: Note | None = None
) -> None:
    """Read a version, apply the changes, write the next one as what they changed."""
    spark = changes.sparkSession
    before, sites = state(spark, root, tables, version)
    outcome = decide_batch(before, sites, changes, rule, on_reject)
    outcome.rejected.write.mode("overwrite").parquet(f"{root}/{_REJECTED}/v={version + 1}")
    write_deltas({_LINES: before[_LINES]}, {_LINES: outcome.lines}, f"{root}/{_GLOBAL}", version + 1)
    write_deltas(sites, outcome.deltas, f"{root}/{_SITES}", version + 1, note)


def make_whole(spark: SparkSession, root: str, tables: Tables) -> int:
    """Write the last version as whole tables, the next version, so that later reads start from it."""
    version = last_version(spark, f"{root}/{_SITES}")
    now, sites = state(spark, root, tables, version)
    fragment_write({_LINES: now[_LINES].withColumn("site", F.lit(NOWHERE))}, f"{root}/{_GLOBAL}", version + 1, same=True)
    return fragment_write(sites, f"{root}/{_SITES}", version + 1, same=True)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when it made the checkpoint; a new checkpoint, even at an old path, has another."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def apply_once(
    changes: DataFrame, batch_id: int, root: str, tables: Tables, rule: Rule, checkpoint: str, on_reject: str, whole_every: int
) -> None:
    """Apply a micro-batch of the stream of that checkpoint, unless it has been applied; see ``stream_apply``."""
    spark, sites = changes.sparkSession, f"{root}/{_SITES}"
    low, high = changes.agg(F.min("seq"), F.max("seq")).first()
    note = Note(_stream_id(spark, checkpoint), batch_id, high, low)
    if applied(spark, sites, note):
        return
    done = last_seq(spark, sites)
    if low is not None and done is not None and low <= done:
        raise ValueError(f"batch {batch_id} begins at seq {low}, but seq {done} has been applied")
    version = last_version(spark, sites)
    apply_version(changes, root, tables, rule, version, on_reject, note)
    if (version + 1) % whole_every == 0:
        make_whole(spark, root, tables)


def stream_apply(
    stream: DataFrame, root: str, tables: Tables, rule: Rule, checkpoint: str, on_reject: str = QUARANTINE, whole_every: int = 50
) -> StreamingQuery:
    """Apply each micro-batch to the last version and write the next.

    The sites' commit row is written last and names the stream, the batch and the lowest and highest
    ``seq`` applied. A batch whose row is there, with the same range, is not applied again; one that failed
    before it is run again and replaces what it had written. Changes act in the order of ``seq``, which all feeds of a
    store share: a batch that reaches below what has been applied fails. After every ``whole_every`` versions the
    tables are written whole, so that reads do not go through ever more changes.
    """

    def apply(changes: DataFrame, batch_id: int) -> None:
        apply_once(changes, batch_id, root, tables, rule, checkpoint, on_reject, whole_every)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain(query: StreamingQuery) -> None:
    """Wait until an available-now query has taken everything; raises what it raised."""
    query.awaitTermination()
