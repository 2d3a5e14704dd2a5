"""Fragments on shared storage: whole versions, and versions that hold only what changed.

``full/<table>/v=<n>`` is a whole table. ``gone/<table>/v=<n>`` and ``added/<table>/v=<n>``
are the keys a version took out and the rows it put in. Reading a version takes the last
whole one before it, leaves out every key that changed since (an anti join with the
changes, the small side) and adds the last state of those keys; no whole table is
shuffled, sorted or rewritten for a batch of changes.

A version counts once its commit row is written, after all its tables. It is never
written while it is read, and writing it again replaces it, so a batch that failed
half-way is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.schema import KEYS, SCHEMAS
from sitewise.session import exists, settle, together

Frags = dict[str, DataFrame]


@dataclass
class Delta:
    """What a batch takes out of a table, as (site, key), and the rows it puts in. An
    updated row is in both."""

    gone: DataFrame
    added: DataFrame


Deltas = dict[str, Delta]


@dataclass(frozen=True)
class Note:
    """What a commit row says of the micro-batch it applied: stream, batch, highest and lowest ``seq``."""

    stream: str | None = None
    batch: int | None = None
    seq: int | None = None
    low: int | None = None


_COMMITS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("line_names_client", T.BooleanType()),
        T.StructField("tables", T.StringType()),
        T.StructField("changed", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("same", T.BooleanType()),
    ]
)
_VERSION = "_version"


def apply_deltas(frags: Frags, deltas: Deltas) -> Frags:
    """The tables after the changes; a table without changes is passed through."""
    new = dict(frags)
    for name, delta in deltas.items():
        on = ["site", KEYS[name]]
        new[name] = frags[name].join(delta.gone.select(*on), on, "left_anti").unionByName(delta.added)
    return new


def merge(earlier: Delta, later: Delta) -> Delta:
    """Two batches after each other as one."""
    on = later.gone.columns
    kept = earlier.added.join(later.gone, on, "left_anti")
    return Delta(earlier.gone.select(*on).unionByName(later.gone), kept.unionByName(later.added))


def _commit(
    spark: SparkSession, root: str, version: int, whole: bool, with_client: bool, tables: list[str], changed: list[str], note: Note | None = None, same: bool = False
) -> None:
    note = note or Note()
    path = f"{root}/commits/v={version}"
    if exists(spark, path):
        held = spark.read.schema(_COMMITS).parquet(path).first()
        if held is not None and note.stream and Note(*(held[name] for name in ("stream", "batch", "seq", "low"))) != note:
            raise ValueError(f"version {version} under {root} is that of another writer: {held}")
    row = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.lit(whole).alias("whole"),
        F.lit(with_client).alias("line_names_client"),
        F.lit(",".join(sorted(tables))).alias("tables"),
        F.lit(",".join(sorted(changed))).alias("changed"),
        F.lit(note.stream).cast("string").alias("stream"),
        F.lit(note.batch).cast("bigint").alias("batch"),
        F.lit(note.seq).cast("bigint").alias("seq"),
        F.lit(note.low).cast("bigint").alias("low"),
        F.lit(same).alias("same"),
    )
    row.write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, root: str, table: str, version: int = 0) -> DataFrame:
    """One whole table, partitioned by site; gives the stored table. Not visible before the commit."""
    path = f"{root}/full/{table}/v={version}"
    df.write.mode("overwrite").option("compression", "zstd").partitionBy("site").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def commit_whole(frags: Frags, root: str, version: int = 0, same: bool = False) -> None:
    lines = frags["lignes_commandes"]
    _commit(lines.sparkSession, root, version, True, "id_client" in lines.columns, list(frags), [], same=same)


def fragment_write(frags: Frags, root: str, version: int = 0, same: bool = False) -> int:
    """Write every table of all sites whole, then commit the version. ``same``: it holds the rows of the one before."""
    spark = frags["lignes_commandes"].sparkSession
    together(spark, [partial(write_table, df, root, name, version) for name, df in frags.items()])
    commit_whole(frags, root, version, same)
    return version


def write_deltas(frags: Frags, deltas: Deltas, root: str, version: int, note: Note | None = None) -> int:
    """Write only what a batch changed (``frags`` are the tables it changed), then commit, with the batch's note."""
    jobs = []
    for name, delta in deltas.items():
        jobs += [
            delta.gone.select("site", KEYS[name]).write.mode("overwrite").parquet,
            delta.added.write.mode("overwrite").parquet,
        ]
    paths = [f"{root}/{part}/{name}/v={version}" for name in deltas for part in ("gone", "added")]
    lines = frags["lignes_commandes"]
    together(lines.sparkSession, [partial(job, path) for job, path in zip(jobs, paths)])
    _commit(lines.sparkSession, root, version, False, "id_client" in lines.columns, list(frags), list(deltas), note)
    return version


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    if not exists(spark, f"{root}/commits"):
        return None
    return spark.read.schema(_COMMITS).option("recursiveFileLookup", True).parquet(f"{root}/commits")


def applied(spark: SparkSession, root: str, note: Note) -> bool:
    """Whether a version holds that batch of that stream. One of another range of ``seq`` under its name is an error."""
    commits = _commits(spark, root)
    if commits is None:
        return False
    held = commits.where((F.col("stream") == note.stream) & (F.col("batch") == note.batch)).first()
    if held is not None and (held["low"], held["seq"]) != (note.low, note.seq):
        raise ValueError(f"batch {note.batch} of stream {note.stream} was applied with seq {held['low']} to {held['seq']}, not {note.low} to {note.seq}")
    return held is not None


def last_seq(spark: SparkSession, root: str) -> int | None:
    """The highest ``seq`` that a noted batch has applied, whatever its stream: the feeds of a store share one numbering."""
    commits = _commits(spark, root)
    return None if commits is None else commits.agg(F.max("seq")).first()[0]


def last_version(spark: SparkSession, root: str) -> int | None:
    """The last committed version, None if there is none."""
    commits = _commits(spark, root)
    return None if commits is None else commits.agg(F.max("version")).first()[0]


def _changes(spark: SparkSession, root: str, part: str, table: str, fields: list, versions: list[int]) -> DataFrame:
    """What those versions hold of a table; one that is missing is an error."""
    schema = T.StructType([*fields, T.StructField("v", T.LongType())])
    home = f"{root}/{part}/{table}"
    stored = spark.read.schema(schema).option("basePath", home).parquet(*[f"{home}/v={v}" for v in versions])
    return stored.withColumnRenamed("v", _VERSION)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> Frags:
    """All sites of a version (the last one by default)."""
    if version is None:
        version = last_version(spark, root)
    commits = _commits(spark, root)
    if commits is None or version is None:
        raise FileNotFoundError(f"no committed version under {root}")
    found = commits.where(F.col("version") <= version).agg(
        F.max("version").alias("version"),
        F.max(F.when(F.col("whole"), F.col("version"))).alias("base"),
        F.max_by("line_names_client", "version").alias("line_names_client"),
        F.max_by("tables", "version").alias("tables"),
    ).first()
    if found["version"] != version:
        raise FileNotFoundError(f"version {version} under {root} is not committed")

    later = commits.where((F.col("version") > found["base"]) & (F.col("version") <= version)).select("version", "changed").collect()
    frags = {}
    for name in found["tables"].split(","):
        fields = list(SCHEMAS[name].fields)
        if name == "lignes_commandes" and found["line_names_client"]:
            fields.append(T.StructField("id_client", T.LongType()))
        site = T.StructField("site", T.IntegerType())
        columns = [*fields, site]
        table = spark.read.schema(T.StructType(columns)).parquet(f"{root}/full/{name}/v={found['base']}")
        versions = sorted(row["version"] for row in later if name in (row["changed"] or "").split(","))
        if versions:
            on = ["site", KEYS[name]]
            key = T.StructField(KEYS[name], T.LongType())
            gone = _changes(spark, root, "gone", name, [site, key], versions)
            added = _changes(spark, root, "added", name, columns, versions)
            touched = gone.unionByName(added.select(*gone.columns))
            last = touched.groupBy(*on).agg(F.max(_VERSION).alias(_VERSION))
            # A single version holds nothing but last states.
            live = (added.join(last, [*on, _VERSION], "left_semi") if len(versions) > 1 else added).drop(_VERSION)
            table = table.join(last.select(*on), on, "left_anti").unionByName(live)
        frags[name] = table
    return frags


def changed_rows(spark: SparkSession, root: str, table: str, earlier: int, later: int) -> tuple[DataFrame, DataFrame]:
    """The rows of a table that the versions after ``earlier`` up to ``later`` touched, as they stood in either.

    The change folders in between name the keys and hold their last state; the earlier state of those keys
    is read from the earlier version, within their range. Only where a whole version with new rows lies
    in between are both versions given whole.
    """
    if earlier > later:
        raise ValueError(f"version {earlier} is after version {later}")
    before, after = read_version(spark, root, earlier)[table], read_version(spark, root, later)[table]
    between = _commits(spark, root).where((F.col("version") > earlier) & (F.col("version") <= later)).collect()
    if any(row["whole"] and not row["same"] for row in between):
        return before, after
    versions = sorted(row["version"] for row in between if table in (row["changed"] or "").split(","))
    if not versions:
        return before.where(F.lit(False)), before.where(F.lit(False))
    on = ["site", KEYS[table]]
    fields = [T.StructField("site", T.IntegerType()), T.StructField(KEYS[table], T.LongType())]
    gone = _changes(spark, root, "gone", table, fields, versions)
    added = _changes(spark, root, "added", table, list(after.schema.fields), versions)
    last = settle(gone.unionByName(added.select(*gone.columns)).groupBy(*on).agg(F.max(_VERSION).alias(_VERSION)))
    low, high = last.agg(F.min(KEYS[table]), F.max(KEYS[table])).first()
    # They meet by key, the site being compared: who goes on by key need not deal the rows out again.
    same = (F.col(f"b.{KEYS[table]}") == F.col(f"l.{KEYS[table]}")) & (F.col("b.site") - F.col("l.site") == 0)
    old = before.where(F.col(KEYS[table]).between(low, high)).alias("b").join(last.alias("l"), same, "left_semi")
    if len(versions) > 1:  # a single version holds nothing but last states
        added = added.join(last, [*on, _VERSION], "left_semi")
    return old, added.drop(_VERSION)


def fragment_read(spark: SparkSession, root: str, site: int, views: bool = False) -> Frags:
    """One site's tables, by their local names; only that site's files are read.

    With ``views`` they are also registered as ``<table>_<site>``.
    """
    local = {name: df.where(F.col("site") == site).drop("site") for name, df in read_version(spark, root).items()}
    if views:
        for name, df in local.items():
            df.createOrReplaceTempView(f"{name}_{site}")
    return local
