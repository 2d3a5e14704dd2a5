r"""Near copies by SimHash, found with pivot distance tables.

A fingerprint bit is set if it is set in over half of the hashes of a text's word
shingles. Fingerprints that differ in few bits are linked. Two fingerprints within 3 bits
agree in at least two of five bit blocks, so each is dealt to ten buckets (one for each
pair of blocks). In a bucket, its Hamming distances to reference fingerprints (pivots) are
tabulated: a pair whose distances to any pivot differ by more than 3 cannot be within 3,
so rows are ordered by the first pivot, only rows within 3 of it are paired, the maximum
difference over the other pivots discards most of these, and the rest is verified.

* Equal fingerprints are one node from the start, so copies never make pairs; a task
  returns a spanning star of what it found linked, never all pairs of a dense group.
* A bucket with more than ``BUCKET_ROWS`` fingerprints is cut into chunks, and each pair of
  chunks is a task's work of its own; nothing is left out.
* Null or empty texts have fingerprint 0. Null ids: rows of their own; a component of such
  rows only has a null id. Repeated rows give repeated results. Empty table: no rows.
* Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm.common import free_name, table
from sitewise.llm.components import components
from sitewise.session import release, settle

BITS = 3
PIVOTS = 16
BUCKET_ROWS = 4_096
SEED = 42
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, bits
STEP = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    tokens = (text or "").encode().translate(_LOWER).split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False)))
    set_bits = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), STEP):
        some = shingles[start : start + STEP]
        hashes = np.fromiter(map(_hash, some), dtype="<u8", count=len(some))
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * set_bits > len(shingles), bitorder="little").view("<u8")[0])


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _hash(shingle: bytes) -> int:
    return xxhash.xxh64_intdigest(shingle, SEED)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(mark, schema)


def _buckets() -> Column:
    """The ten bucket keys: number of the pair of blocks in the high bits, their bits below."""

    def bits(first: int, n: int) -> Column:
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << n) - 1))

    keys = [
        F.lit(number << 32).bitwiseOR(F.shiftleft(bits(*BLOCKS[i]), 13)).bitwiseOR(bits(*BLOCKS[j]))
        for number, (i, j) in enumerate(combinations(range(5), 2))
    ]
    return F.array(*keys)


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, member) of a spanning forest of the given links between 0 .. n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            member = np.flatnonzero(label != np.arange(n))
            return label[member], member


def _linked(group: np.ndarray, fp: np.ndarray, bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (root, member) that span the links within ``bits`` in each group; fp is (rows, 64-bit words)."""
    far = np.stack([np.bitwise_count(fp ^ p).sum(axis=1, dtype=np.int32) for p in pivots], axis=1)
    order = np.lexsort((far[:, 0], group))
    group, fp, far = group[order], fp[order], far[order]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    active, ahead = np.arange(len(fp) - 1), 1
    while len(active):
        other = active + ahead
        near = (group[other] == group[active]) & (far[other, 0] - far[active, 0] <= bits)
        active, other = active[near], other[near]  # rows are ordered by the first pivot: later ones lie farther
        left, right = active, other
        for k in range(1, far.shape[1]):
            close = np.abs(far[left, k] - far[right, k]) <= bits
            left, right = left[close], right[close]
        true = np.bitwise_count(fp[left] ^ fp[right]).sum(axis=1, dtype=np.int32) <= bits
        if true.any():
            found.append((left[true], right[true]))
            held += int(true.sum())
            if held > 2_000_000:
                found = [_stars(*map(np.concatenate, zip(*found, strict=True)), len(fp))]
                held = len(found[0][0])
        ahead += 1
        active = active[active + ahead < len(fp)]
    if not found:
        return order[:0], order[:0]
    root, member = _stars(*map(np.concatenate, zip(*found, strict=True)), len(fp))
    return order[root], order[member]


def pivot_fingerprints(n: int, words: int = 1) -> np.ndarray:
    return np.array([[xxhash.xxh64_intdigest(f"{i} {k}", SEED) for k in range(words)] for i in range(n)], dtype=np.uint64)


Linker = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _by_distance(bits: int, pivots: np.ndarray) -> Linker:
    """Links between fingerprints (64-bit words as bytes) within ``bits``."""
    return lambda group, fp: _linked(group, np.frombuffer(b"".join(fp), dtype="<u8").reshape(len(fp), -1), bits, pivots)


def _in_buckets(dealt: DataFrame, linked: Linker, limit: int, schema: str, weight: Column | None = None) -> DataFrame:
    """Links ``a, b`` that ``linked`` finds between nodes of ``bucket, node, fp`` rows in some bucket; fp is any bytes.

    ``limit`` bounds the rows (or their weights) that one call gets of a bucket.
    """
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    hot = settle(dealt.groupBy("bucket").agg(total.alias("n")).where(F.col("n") > limit))
    none = F.lit(0).cast("int")
    if hot.isEmpty():
        dealt = dealt.select("bucket", none.alias("i"), none.alias("j"), "node", "fp")
    else:
        # Chunks of a large bucket meet in pairs, each pair a group of its own.
        chunks = F.coalesce(F.ceil(F.col("n") * 2 / limit).cast("int"), F.lit(1))
        dealt = dealt.join(hot, "bucket", "left").withColumn("chunks", chunks)
        own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
        dealt = dealt.select("bucket", own.alias("own"), F.explode(F.sequence(none, F.col("chunks") - 1)).alias("to"), "node", "fp")
        dealt = dealt.select("bucket", F.least("own", "to").alias("i"), F.greatest("own", "to").alias("j"), "node", "fp")

    def links(new: np.ndarray, node: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        pair = np.zeros(len(node), dtype=bool)
        pair[1:] |= ~new[1:]
        pair[:-1] |= ~new[1:]
        group, node, fp = np.cumsum(new)[pair], node[pair], fp[pair]
        root, member = linked(group, fp) if len(node) else (group, group)
        return pa.RecordBatch.from_arrays([pa.array(node[root]), pa.array(node[member])], ["a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]])]
            cut = int(np.flatnonzero(new)[-1])  # the last group may go on in the next batch
            rest = [c[cut:] for c in columns]
            if cut:
                yield links(new[:cut], columns[3][:cut], columns[4][:cut])
        if rest is not None:
            yield links(np.arange(len(rest[0])) == 0, rest[3], rest[4])

    grouped = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return grouped.mapInArrow(link, schema)


def near_links(marks: DataFrame, bits: int = BITS, n_pivots: int = PIVOTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a, b`` between distinct values of fp that span all groups of values within ``bits`` (at most 3)."""
    if not 0 <= bits <= 3:
        raise ValueError("five blocks find values that differ in 3 bits at most")
    dealt = marks.select(F.explode(_buckets()).alias("bucket"), F.col("fp").alias("node"), F.unhex(F.lpad(F.hex("fp"), 16, "0")).alias("fp"))
    return _in_buckets(dealt, _by_distance(bits, pivot_fingerprints(n_pivots)), bucket_rows, "a long, b long")


def near_groups(docs: DataFrame, words: int = 3, bits: int = BITS) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links) of every row."""
    marks = settle(fingerprints(docs, words))
    values = settle(marks.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(values.select("fp"), bits))
    rooted = settle(values.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marks.join(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


# Copies by similarity: keys and wide fingerprints of 5-word shingles give pairs, their sets decide.
WIDE_BITS = 512
WIDE_WORDS = 5
BANDS, BAND_MINIMA = 24, 5
SIMILARITY = 0.8
GROUP_SHINGLES = 1 << 21  # shingles that one group may hold; every row counts for ROW_SHINGLES more
ROW_SHINGLES = 256


def _projection() -> np.ndarray:
    """For each of the 8 bytes of a shingle's hash and each of its values, +1 or -1 for each bit.

    Each byte has as many +1 as -1 over its values: else long texts, which hold all values alike,
    would lean to the same side whatever their words.
    """
    halves = np.repeat(np.array([-1, 1], dtype=np.float32), 128)
    columns = np.tile(halves[:, None], (1, 8 * WIDE_BITS))
    mixed = np.random.default_rng(SEED).permuted(columns, axis=0)
    return mixed.reshape(256, 8, WIDE_BITS).transpose(1, 0, 2).reshape(8 * 256, WIDE_BITS)


def _shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct 64-bit hashes of a text's word shingles, in order."""
    tokens = (text or "").encode().translate(_LOWER).split()
    own = np.fromiter(map(_hash, tokens), dtype=np.uint64, count=len(tokens))
    n = max(1, len(own) - words + 1) if len(own) else 0
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(min(words, len(own))):
        mixed = _mix(mixed, own[k : k + n])
    return np.unique(mixed)


def _mix(state: np.ndarray, more: np.ndarray) -> np.ndarray:
    state = (state ^ more) * np.uint64(0x9E3779B97F4A7C15)
    return state ^ (state >> np.uint64(29))


def _wide(shingles: np.ndarray) -> np.ndarray:
    """How often each value occurs in each byte of the hashes."""
    flat = shingles.view(np.uint8).reshape(-1, 8) + np.arange(8) * 256
    return np.bincount(flat.ravel(), minlength=8 * 256)


def _band_keys(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """A key for each text and band, of the least of its shingles in each of the band's orders."""
    sets = [s if len(s) else np.zeros(1, dtype=np.uint64) for s in sets]
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    high = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    keys = np.empty((len(sets), len(factors)), dtype=np.uint64)
    for band, orders in enumerate(factors):
        key = np.full(len(sets), band, dtype=np.uint64)
        for factor in orders:
            key = _mix(key, np.minimum.reduceat(high * factor, starts).astype(np.uint64))
        keys[:, band] = key
    return keys.view(np.int64)


def wide_marks(rows: DataFrame, words: int = WIDE_WORDS) -> DataFrame:
    """The rows (text last) with the text's wide fingerprint and band keys in its place."""
    project = _projection()
    factors = np.random.default_rng(SEED + 1).integers(0, 1 << 31, (BANDS, BAND_MINIMA), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    keep = rows.schema.fields[:-1]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [_shingles(t, words) for t in batch.column(len(keep)).to_pylist()]
                on = np.array([_wide(s) for s in sets], dtype=np.float32) @ project > 0
                fp = [x.tobytes() for x in np.packbits(on, axis=1, bitorder="little")]
                bands = _band_keys(sets, factors)
                columns = [*batch.columns[:-1], pa.array(fp, pa.binary()), pa.array(bands.tolist(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [*[f.name for f in keep], "fp", "bands"])

    fields = [*keep, T.StructField("fp", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    return rows.mapInArrow(mark, T.StructType(fields))


def shingle_sets(rows: DataFrame, words: int = WIDE_WORDS) -> DataFrame:
    """The rows (text last) with ``fp``, the text's shingle hashes as bytes, in its place."""
    keep = rows.schema.fields[:-1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [_shingles(t, words).tobytes() for t in batch.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.binary())], [*[f.name for f in keep], "fp"])

    return rows.mapInArrow(cut, T.StructType([*keep, T.StructField("fp", T.BinaryType())]))


def similar_bits(similarity: float) -> int:
    """Differing bits that sets of that Jaccard similarity practically never exceed: what is expected and 4.5 standard deviations."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(WIDE_BITS * share + 4.5 * math.sqrt(WIDE_BITS * share * (1 - share)))


def _by_jaccard(similarity: float) -> Linker:
    """Links that span the pairs of sets (64-bit hashes as bytes) of at least that similarity, each counted in full."""

    def linked(group: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        roots, members = [], []
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            sizes = np.array([len(s) // 8 for s in sets[start:end]])
            order = np.argsort(sizes, kind="stable")
            sizes = sizes[order]
            values, flat = np.unique(np.frombuffer(b"".join(sets[start:end][order]), dtype="<u8"), return_inverse=True)
            own = np.split(flat, np.cumsum(sizes)[:-1])
            last = np.searchsorted(sizes, sizes / similarity + 1e-9, side="right")
            label, held = np.arange(end - start), np.zeros(len(values), dtype=np.int32)
            for i in range(end - start - 1):
                # Rows that are linked by now need no count; longer ones than last cannot be as similar.
                other = np.flatnonzero(label[i + 1 : last[i]] != label[i]) + i + 1
                if not len(other):
                    continue
                held[own[i]] = 1
                both = np.add.reduceat(held[np.concatenate([own[j] for j in other])], np.r_[0, np.cumsum(sizes[other])[:-1]])
                held[own[i]] = 0
                near = other[both * (1 + similarity) >= similarity * (sizes[i] + sizes[other]) - 1e-9]
                if len(near):
                    roots.append(np.full(len(near), start + order[i]))
                    members.append(start + order[near])
                    label[np.isin(label, label[near])] = label[i]
        if not roots:
            return group[:0], group[:0]
        return np.concatenate(roots), np.concatenate(members)

    return linked


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of one document of each group of near copies: that of the smallest doc_id.

    Two texts are linked if the sets of their 5-word shingles (as 64-bit hashes) have at least that
    Jaccard similarity, counted in full. To find such pairs, texts are dealt to 24 buckets, each by the
    least of its shingles in five orders, and rows of a bucket whose 512-bit fingerprints differ in
    too many bits are passed over; texts joined by what is left form groups, and in a group all pairs
    are counted. A pair at 0.8 shares no bucket once in 14,000, and once in some 100,000 differs in more bits.
    Texts without words are no copies of each other unless equal. Equal texts are always one group
    (told apart by a 64-bit hash). Null ids come last; of rows equal in id and text one stays.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text).cast("binary"))
    marks = settle(wide_marks(docs.select(key.alias("key"), "doc_id", F.xxhash64(text).alias("node"), "text")))
    dealt = _not_alone(marks)
    close = _by_distance(similar_bits(similarity), pivot_fingerprints(4, WIDE_BITS // 64))
    near = components(_in_buckets(dealt, close, BUCKET_ROWS, "a long, b long"))
    grouped = settle(near.unionByName(near.select(F.col("root").alias("u"), "root").distinct()).select(F.col("u").alias("node"), F.col("root").alias("bucket")))
    release(dealt)
    release(near)
    # Texts travel twice, here and at the end, by merge joins: whatever the corpus, neither side is taken for small.
    texts = docs.select(F.xxhash64(text).alias("node"), "text").join(grouped.hint("merge"), "node").dropDuplicates(["node"])
    sets = settle(shingle_sets(texts.select("bucket", "node", "text")))
    weight = F.octet_length("fp") / 8 + ROW_SHINGLES
    links = _in_buckets(sets, _by_jaccard(similarity), GROUP_SHINGLES, "a long, b long", weight)
    roots = components(links)
    release(sets)
    release(grouped)
    owner = marks.select("key", "doc_id", "node").join(roots.withColumnRenamed("u", "node"), "node", "left")
    owner = settle(owner.select("key", F.coalesce("root", "node").alias("root"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key").alias("place")))
    release(marks)
    release(roots)
    first = owner.groupBy("root").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    others = settle(owner.join(first, "root").where(F.col("place") > F.col("first")).select("key").distinct())
    release(owner)
    name = free_name(docs.columns, "key")
    rest = docs.withColumn(name, key).join(others.withColumnRenamed("key", name).hint("merge"), name, "left_anti")
    return rest.dropDuplicates([name]).select(docs.columns)


def _not_alone(marks: DataFrame) -> DataFrame:
    """``bucket, node, fp`` of the texts that share a bucket with another text, stored.

    Nearly every bucket holds one text. Only ``bucket, node`` travel until these are gone, and the
    fingerprints join what is left. Texts without words are in no bucket.
    """
    worded = marks.where(F.col("fp") != F.lit(bytes(WIDE_BITS // 8)))
    dealt = worded.select(F.explode("bands").alias("bucket"), "node")
    ends = dealt.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = settle(ends.where("low < high").select("bucket"))
    pairs = settle(dealt.join(shared.hint("merge"), "bucket", "left_semi").distinct())
    release(shared)
    named = settle(pairs.select("node").distinct())
    fps = marks.select("node", "fp").join(named, "node", "left_semi").dropDuplicates(["node"])
    found = settle(pairs.join(fps, "node").select("bucket", "node", "fp"))
    release(pairs)
    release(named)
    return found


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
