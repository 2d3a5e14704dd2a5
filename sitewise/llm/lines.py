r"""Line dedup over levelled sorted runs of line hashes.

An index holds the hashes of the lines seen so far in *runs*: stored tables of distinct
hashes, cut into the same buckets by hash and sorted inside each. A new batch of documents is
merge-anti-joined with the runs: the runs are read as they lie, neither shuffled nor grouped again.
What no run holds becomes a run of its own, so runs never share a hash. When ``FANOUT`` runs of a
level are there, they are compacted into one run of the next, so a batch meets few runs however
many batches went before. What of a batch was in a run is noted as a *repeat*: hash and number of documents.

``drop_repeated_lines`` takes batches from the largest ids to the smallest. So the batch that
brings a hash first holds the largest document with it, which its run notes; runs and repeats
together say in how many documents a line stands.

* A line's key: the line without ``[\x20\x09-\x0D]`` at both ends, A-Z lower-cased; keys of under ``MIN_CHARS`` code points
  are never dropped. Keys are told apart by 128 bits of a hash.
* Null or empty text: one empty line. Every row is a document; rows with the same largest id all keep their lines.
* Null ids come last (below every id): where only such rows hold a key, all keep it.
* A line in very many documents is counted per task before anything is shuffled. Empty table: no rows.
* Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm.common import parts, table
from sitewise.session import release, remove, settle, workdir

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 6, 3
HASHES_PER_BUCKET = 2_000_000
BLANK = b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def line_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The hash of a line's key; None for a key that is too short."""
    key = line.strip(BLANK)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key.translate(_LOWER), digest_size=16).digest()


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc``, ``own`` and ``h``: every row with the hash of each of its different long lines."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(1)):
                data = (text.as_py() or "").encode()
                if len(data) >= min_chars:
                    own = {line_hash(line, min_chars) for line in data.split(b"\n")} - {None}
                    rows += [i] * len(own)
                    found += own
            place = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(place), batch.column(2).take(place), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "own", "h"])

    fields = [T.StructField("doc", docs.schema["doc_id"].dataType), T.StructField("own", T.LongType()), T.StructField("h", T.BinaryType())]
    return docs.select("doc_id", "text", _own("doc_id")).mapInArrow(cut, T.StructType(fields))


@dataclass
class LineIndex:
    """Runs of line hashes by level, and the repeats that batches found in them.

    A run is an external table, bucketed and sorted by ``h``, with what the first batch says of a
    hash: ``n`` documents, ``last`` the largest of them. ``drop`` forgets the runs and removes their files.
    """

    spark: SparkSession
    buckets: int
    runs: list[list[str]] = field(default_factory=list)
    repeats: list[DataFrame] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [name for level in self.runs for name in level]

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"sitewise_run_{uuid.uuid4().hex}"
        self.paths[name] = workdir(self.spark, "run")
        # One task writes one bucket whole, so that each bucket of a run is one sorted file.
        dealt = rows.repartition(self.buckets, "h")
        dealt.write.format("parquet").bucketBy(self.buckets, "h").sortBy("h").option("path", self.paths[name]).saveAsTable(name)
        while len(self.runs) <= level:
            self.runs.append([])
        self.runs[level].append(name)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, self.paths.pop(name))

    @contextmanager
    def _as_they_lie(self) -> Iterator[None]:
        """Plans made inside take the order in which a run's files are written for sorted, as each bucket is one file."""
        key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def add(self, hashes: DataFrame) -> None:
        """A batch of ``doc, h`` rows, one for each row and hash. Stored with its run before it returns."""
        own = settle(hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("last")))
        known, new = self.names(), own
        with self._as_they_lie():
            for name in known:
                new = new.join(self.spark.table(name).select("h").hint("merge"), "h", "left_anti")
            self._write(new, 0)
            if known:
                run = self.spark.table(self.runs[0][-1]).select("h")
                self.repeats.append(settle(own.join(run.hint("merge"), "h", "left_anti").select("h", "n")))
        release(own)
        self._compact()

    def _compact(self) -> None:
        for level in range(len(self.runs)):
            full = self.runs[level]
            if len(full) >= FANOUT:
                rows = self.spark.table(full[0])
                for name in full[1:]:
                    rows = rows.unionByName(self.spark.table(name))
                self._write(rows, level + 1)
                self.runs[level] = []
                self._forget(full)

    def frequent(self, min_docs: int) -> DataFrame:
        """``h, last`` of the hashes found in at least so many documents, stored."""
        again = None
        for repeat in self.repeats:
            again = repeat if again is None else again.unionByName(repeat)
        if again is None:
            again = self.spark.createDataFrame([], "h binary, n long")
        again = settle(again.groupBy("h").agg(F.sum("n").alias("more")))
        found = None
        with self._as_they_lie():
            for name in self.names():
                run = self.spark.table(name).join(again.hint("merge"), "h", "left")
                some = run.where(F.col("n") + F.coalesce("more", F.lit(0)) >= min_docs).select("h", "last")
                found = some if found is None else found.unionByName(some)
            found = settle(found)
        release(again)
        return found

    def drop(self) -> None:
        self._forget(self.names())
        for repeat in self.repeats:
            release(repeat)
        self.runs, self.repeats = [], []


def _batch_of(ids: DataFrame, batches: int) -> Column:
    """The number of an id's batch, 0 for the largest ids; a batch is a range of ids, null ids are in the last."""
    cuts = ids.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 10_000)).first()[0] if batches > 1 else None
    batch = F.lit(batches - 1)
    for k, cut in enumerate(sorted(set(cuts or []))):
        batch = F.when(F.col("doc") > F.lit(cut), F.lit(batches - 2 - k)).otherwise(batch)
    return batch


def _own(id_column: str) -> Column:
    """Tells rows without an id apart by their text; 0 for the others."""
    return F.when(F.col(id_column).isNull(), F.xxhash64("text")).otherwise(F.lit(0))


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``doc, own, h`` of the lines that a document loses: keys of at least ``min_docs`` documents, but in the largest id. Stored."""
    spark = docs.sparkSession
    path = workdir(spark, "lines")
    dealt = line_hashes(docs, min_chars).withColumn("batch", _batch_of(docs, batches))
    dealt.write.partitionBy("batch").parquet(path)
    hashes = spark.read.schema(dealt.schema).parquet(path)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = LineIndex(spark, parts(hashes, hashes.count(), HASHES_PER_BUCKET, least))
    for k in range(batches):
        index.add(hashes.where(F.col("batch") == k).select("doc", "h"))
    frequent = index.frequent(min_docs)
    index.drop()
    lost = settle(hashes.join(frequent, "h").where(~F.col("doc").eqNullSafe(F.col("last"))).select("doc", "own", "h"))
    release(frequent)
    remove(spark, path)
    return lost


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the lines that stay, joined) of every row."""
    docs = docs.select("doc_id", "text")
    lost = repeated_lines(docs, min_docs, min_chars, batches)
    # A document's lost lines as one short list: half a hash tells the lines of one document apart.
    lists = settle(lost.groupBy("doc", "own").agg(F.collect_set(F.conv(F.substring(F.hex("h"), 1, 16), 16, -10).cast("long")).alias("lost")))
    release(lost)
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (_own("doc_id") == F.col("own"))
    marked = docs.join(lists.hint("merge"), same, "left").select("doc_id", "text", "lost")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = [_kept(t or "", gone, min_chars) for t, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                n, dropped, kept = zip(*rows, strict=True)
                columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept"])

    fields = [docs.schema["doc_id"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())]
    return marked.mapInArrow(keep, T.StructType(fields))


def _kept(text: str, lost: list[int] | None, min_chars: int) -> tuple[int, int, str]:
    if not lost:
        return text.count("\n") + 1, 0, text
    gone = set(lost)
    lines = text.encode().split(b"\n")
    hashes = (line_hash(line, min_chars) for line in lines)
    stay = [line for line, h in zip(lines, hashes, strict=True) if h is None or int.from_bytes(h[:8], signed=True) not in gone]
    return len(lines), len(lines) - len(stay), b"\n".join(stay).decode()


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT id, doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT id) >= 5
), j AS (
  SELECT k.id, k.doc_id, i, line, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.last AS gone FROM k LEFT JOIN f USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY id
"""
