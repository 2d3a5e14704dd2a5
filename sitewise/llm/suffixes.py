r"""Removal of repeated byte strings over positions sampled by content.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else is removed.
The dealt method is a difference-cover suffix sort: triples at covered positions sorted and ranked, recursion on
the ranks, the other suffixes merged in. What is done here takes its idea, a sample that any two equal
strings share, and replaces the sort: positions are hashed and counted, there are no ranks and no recursion.

1. *Sample.* Positions chosen by content (the least hash of ``GRAM`` bytes in each window), about one in 85, so
   that any two equal strings of ``LENGTH`` bytes hold a sampled position at the same offset.
2. *Name.* Each sampled position gets two 64-bit names: of the ``GRAM`` bytes at it, and of its stretch
   (everything that the windows it was chosen for cover). They are counted: a stretch found twice is
   repeated in whole, a sampled name found once is in no repeat.
3. *Edges.* Only positions whose name is repeated while their stretches differ go on. One occurrence of
   each different stretch is taken, and the starts in it are named by sampled name and a hash of their
   offset to it and their ``LENGTH`` bytes; equal ones are repeats.

Equality rests on 128 bits of hashes together: a name and a stretch, or a name and a start.

* Null text: empty. Texts under ``LENGTH`` bytes lose nothing. Null ids and repeated rows: a row each;
  copies of a text of ``LENGTH`` bytes lose all of it.
* Texts of any length are read in overlapping steps of ``STEP`` bytes.
* Columns other than id and text are ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm.common import table, whole
from sitewise.session import release, settle

LENGTH = 200
GRAM = 32
STEP = 1 << 22
HOT_NAME = 20_000  # different stretches of one name that a task takes together; beyond, starts are dealt out singly
BATCH_ROWS = 256

_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(0, 2**64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2**64
MIX = np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64((1 << 24) - 1)


class _Powers:
    """Powers of the base and of its inverse, as far as needed so far."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << max(16, n.bit_length())
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class Bytes:
    """Hashes of substrings of one step of a text."""

    def __init__(self, data: bytes):
        codes = np.frombuffer(data, dtype=np.uint8)
        self.n = len(codes)
        up, self.down = _Powers.to(self.n + 1)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[codes] * up[: self.n], out=self.sums[1:])

    def names(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self.down[start])

    def all_names(self, length: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Names of the substrings of that length from every start in start .. stop - 1."""
        stop = self.n - length + 1 if stop is None else stop
        return _mixed((self.sums[start + length : stop + length] - self.sums[start:stop]) * self.down[start:stop])


def sampled(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """first and last start, sampled position, name and stretch of each run of starts with one sampled position."""
    if len(data) < length:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),) * 2
    text = Bytes(data)
    names = text.all_names(gram)
    width = length - gram + 1
    starts = text.n - length + 1
    ranked = (names & ~LOW) | np.arange(len(names), dtype=np.uint64)
    rows = -(-len(ranked) // width)
    grid = np.full(rows * width, np.uint64(2**64 - 1))
    grid[: len(ranked)] = ranked
    grid = grid.reshape(rows, width)
    upto = np.minimum.accumulate(grid, axis=1).ravel()
    onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(onward[:starts], upto[width - 1 : width - 1 + starts]) & LOW).astype(np.int64)
    change = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
    first = np.r_[0, change]
    last = np.r_[change - 1, starts - 1]
    at = chosen[first]
    stretch = text.names(first, last + length)
    stretch = _mixed(stretch + (at - first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + (last - first).astype(np.uint64) * MIX)
    return first, last, at, names[at], stretch


def _steps(data: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """Overlapping pieces: every string of that length lies whole in exactly one that it starts in."""
    for start in range(0, max(1, len(data) - length + 1), STEP):
        yield start, data[start : start + STEP + length - 1]


def _place(first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """first, last - first and at - first in one number."""
    return (first << 20) | ((last - first) << 10) | (at - first)


def _first(place: Column) -> Column:
    return F.shiftright(place, 20)


def _last(place: Column) -> Column:
    return F.shiftright(place, 20) + F.shiftright(place, 10).bitwiseAND(F.lit(1023))


def runs(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, place, name and stretch of every sampled position of ``key, text`` rows."""
    if length > 1_000:
        raise ValueError("places hold stretches of up to 1,000 starts")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, text in enumerate(batch.column(1)):
                for start, data in _steps((text.as_py() or "").encode(), length):
                    first, last, at, name, stretch = sampled(data, length)
                    found.append((_place(first + start, last + start, at + start), name.view(np.int64), stretch.view(np.int64)))
                    owner.append(np.full(len(first), i))
            columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 3
            rows = pa.array(np.concatenate(owner) if owner else np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), *columns], ["key", "place", "name", "stretch"])

    return texts.select("key", "text").mapInArrow(sample, "key binary, place long, name long, stretch long")


def stretch_bytes(asked: DataFrame, length: int = LENGTH) -> DataFrame:
    """The bytes of the asked stretches: ``key, packed, asked`` rows in, name, key, place, data out."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                out: list[list] = [[], [], [], []]
                for key, packed, asks in zip(*[c.to_pylist() for c in batch.slice(at, BATCH_ROWS).columns], strict=True):
                    text = zlib.decompress(packed)
                    for ask in asks:
                        first, more = ask["place"] >> 20, ask["place"] >> 10 & 1023
                        for column, value in zip(out, (ask["name"], key, ask["place"], text[first : first + more + length]), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["name", "key", "place", "data"])

    return asked.select("key", "packed", "asked").mapInArrow(spell, "name long, key binary, place long, data binary")


def _starts(name: np.ndarray, place: np.ndarray, data: list[bytes], length: int):
    """All starts of the stretches: number of the stretch, start, and sort key (name, offset, own bytes)."""
    joined = Bytes(b"".join(data))
    more = (place >> 10 & 1023) + 1
    row = np.repeat(np.arange(len(data)), more)
    within = np.arange(len(row)) - np.repeat(np.cumsum(more) - more, more)
    base = np.cumsum([0] + [len(d) for d in data[:-1]])
    at = base[row] + within
    own = joined.names(at, at + length)
    offset = (place & 1023)[row] - within
    sort = _mixed(own + offset.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + name.view(np.uint64)[row] * MIX)
    return row, (place >> 20)[row] + within, sort


def edge_repeats(stretches: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, first, last of starts that two different stretches of one name share; groups by name."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            name = rows.column(0).to_numpy()
            cut = int(np.searchsorted(name, name[-1]))  # the last name may go on in the next batch
            rest = rows.slice(cut)
            if cut:
                yield from repeated(rows.slice(0, cut))
        if rest is not None:
            yield from repeated(rest)

    def repeated(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        name, place = rows.column(0).to_numpy(), rows.column(2).to_numpy()
        row, start, sort = _starts(name, place, rows.column(3).to_pylist(), length)
        order = np.argsort(sort, kind="stable")
        same = sort[order][1:] == sort[order][:-1]
        twice = np.zeros(len(row), dtype=bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        row, start = row[twice], start[twice]
        head = np.r_[True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)] if len(row) else np.zeros(0, dtype=bool)
        first = np.flatnonzero(head)
        last = np.r_[first[1:], len(row)] - 1 if len(first) else first
        keys = rows.column(1).combine_chunks().take(pa.array(row[first]))
        yield pa.RecordBatch.from_arrays([keys, pa.array(start[first]), pa.array(start[last])], ["key", "first", "last"])

    together = stretches.select("name", "key", "place", "data").repartition("name").sortWithinPartitions("name")
    return together.mapInArrow(compare, "key binary, first long, last long")


def hot_edge_repeats(stretches: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for names with very many stretches: their starts are dealt out by name and sort key."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, place = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            if len(name):
                row, start, sort = _starts(name, place, batch.column(3).to_pylist(), length)
                columns = [pa.array(name[row]), batch.column(1).take(pa.array(row)), pa.array(start), pa.array(sort.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["name", "key", "first", "sort"])

    starts = settle(stretches.select("name", "key", "place", "data").mapInArrow(spread, "name long, key binary, first long, sort long"))
    twice = starts.groupBy("name", "sort").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name", "sort")
    return starts.join(twice, ["name", "sort"], "left_semi").select("key", "first", F.col("first").alias("last"))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, spans``: for each text (by md5) with a repeat, the starts (first, last) of repeated strings."""
    texts = docs.select(F.unhex(F.md5(whole(F.col("text")).cast("binary"))).alias("key"), "text")
    found = settle(runs(texts, length))
    again = settle(found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"))
    named = settle(found.join(again, "name", "left_semi"))
    release(found)
    stretches = settle(named.groupBy("name", "stretch").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("one")))
    different = stretches.groupBy("name").agg(F.count(F.lit(1)).alias("different")).where("different > 1")
    entire = named.join(stretches.where("n > 1").select("name", "stretch"), ["name", "stretch"], "left_semi")
    edges = stretches.join(different, "name").select("name", "one.*", (F.col("different") > HOT_NAME).alias("hot"))
    asked = settle(edges.groupBy("key").agg(F.collect_list(F.struct("place", "name")).alias("asked"), F.max("hot").alias("hot")))
    packed = packed_texts(texts).dropDuplicates(["key"])  # copies meet before the shuffle
    spelt = settle(stretch_bytes(packed.join(asked, "key"), length))
    if asked.where("hot").isEmpty():
        partly = edge_repeats(spelt, length)
    else:
        hot = settle(different.where(F.col("different") > HOT_NAME).select("name"))
        partly = edge_repeats(spelt.join(hot, "name", "left_anti"), length)
        partly = partly.unionByName(hot_edge_repeats(spelt.join(hot, "name", "left_semi"), length))
    ranges = entire.select("key", _first(F.col("place")).alias("first"), _last(F.col("place")).alias("last")).unionByName(partly)
    spans = settle(ranges.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("spans")))
    for done in (named, stretches, asked, spelt):
        release(done)
    return spans


def packed_texts(texts: DataFrame) -> DataFrame:
    """The rows with the text deflated: they are shuffled to meet what was found in them."""

    def deflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                last = pa.array([zlib.compress((t.as_py() or "").encode(), 1) for t in part.column(part.num_columns - 1)], pa.binary())
                yield part.set_column(part.num_columns - 1, "packed", last)

    fields = [*texts.schema.fields[:-1], T.StructField("packed", T.BinaryType())]
    return texts.mapInArrow(deflate, T.StructType(fields))


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of (start, stop) byte ranges; ranges that touch are one."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, stop in bytes) and, if asked for, kept (bytes)."""
    found = repeats(docs, length)
    text = whole(F.col("text"))
    rows = docs.select("doc_id", F.unhex(F.md5(text.cast("binary"))).alias("key"), "text")
    met = packed_texts(rows).join(found, "key", "left").select("doc_id", "packed", "spans")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    kept = [T.StructField("kept", T.BinaryType())] if with_kept else []
    schema = T.StructType(
        [
            docs.select("doc_id").schema[0],
            *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
            *kept,
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                out: list[list] = [[] for _ in schema.fields[1:]]
                for packed, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    data = zlib.decompress(packed)
                    gone = merged([(s["first"], s["last"] + length) for s in spans or []])
                    pieces, upto = [], 0
                    for start, stop in gone:
                        pieces.append(data[upto:start])
                        upto = stop
                    rest = b"".join([*pieces, data[upto:]])
                    row = (len(data), len(data) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), [{"start": a, "stop": b} for a, b in gone], rest)
                    for column, value in zip(out, row, strict=False):
                        column.append(value)
                kinds = [pa.int64()] * 3 + [pa.string(), span, pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], [f.name for f in schema])

    return met.mapInArrow(cut, schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
