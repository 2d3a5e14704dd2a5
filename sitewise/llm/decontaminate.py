r"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap of question and answer.

Items are cut into chunks of at most ``PASSAGE // 2`` words and indexed; every document is
cut into passages of ``PASSAGE`` words that overlap by half, so each chunk's length fits whole
into some passage. A passage is a query: all chunks whose BM25 score, as a share of the
chunk's score for itself, reaches the threshold are retrieved. Then the document must hold
the item's question and answer: shares of their word runs of three.

Before a passage is put to the index, a bound over the whole document batch drops passages
that cannot reach the threshold for any chunk: the terms of least weight are set aside as
long as they cannot reach it alone, so a passage needs one of the others, and what it has
of them plus all that was set aside must reach the threshold. WAND then walks the
postings of the rest, with upper bounds for each block of postings. Both bounds are exact.

* Items: an item's question is its text up to the last sentence or line, the answer the rest;
  sentences of fewer than three words join the one before; of one-sentence items both are the whole. Items without words are never found.
* The benchmark is indexed in blocks of ``ITEMS_PER_BLOCK`` items (chosen by a hash of the id, so
  a block's size is bounded); each block is a pass over all documents. Nothing else is broadcast.
  How many chunks hold a term, the number of chunks and their mean length are counted over all items, so scores do not depend on the blocks.
* Null or empty texts have no passages. Null or repeated ids: matches for each row. Repeated
  items: matches for each. Empty tables: no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sitewise.llm.common import table
from sitewise.session import settle

PASSAGE = 128
THRESHOLD = 0.6
OVERLAP = 0.6
RUN = 3
K1, B = 1.2, 0.75
POSTINGS_PER_BLOCK = 32
ITEMS_PER_BLOCK = 20_000
BATCH_ROWS = 256
SLACK = 1e-9  # sums are taken in different orders
WORD = re.compile(r"\w+")
BOUNDARY = re.compile(r"[.!?\n]+\s*")
ASIDE = 0.6  # share of the threshold that the terms set aside may reach


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[str, str]:
    """The text up to the last sentence or line of at least ``RUN`` words, and the rest; both whole if either would be shorter."""
    for cut in reversed(list(BOUNDARY.finditer(text))):
        if len(words_of(text[cut.end() :])) >= RUN:
            if len(words_of(text[: cut.end()])) >= RUN:
                return text[: cut.end()], text[cut.end() :]
            break
    return text, text


def runs(words: Sequence[str], length: int = RUN) -> set[tuple[str, ...]]:
    """All runs of that many words; the whole of a shorter text."""
    return set(zip(*[words[i:] for i in range(min(length, len(words)))], strict=False))


def share(part: set[tuple[str, ...]], words: Sequence[str], held: dict[int, set]) -> float:
    """How many of the part's runs the words hold; ``held`` keeps the words' runs by length."""
    length = len(next(iter(part)))
    if length not in held:
        held[length] = runs(words, length)
    return len(part & held[length]) / len(part)


@dataclass
class Index:
    """Postings by term: chunk numbers in order, contributions (shares of the chunk's own score), block maxima."""

    items: list
    chunk_item: np.ndarray
    terms: dict[str, int]
    postings: list[tuple[np.ndarray, np.ndarray]]
    questions: list[set]
    answers: list[set]
    threshold: float
    rare: np.ndarray = field(init=False)  # by term: whether it can be needed to reach the threshold
    aside: np.ndarray = field(init=False)  # by chunk: what the other terms can add

    def __post_init__(self):
        self.top = [float(w.max()) for _, w in self.postings]
        self.blocks = [np.maximum.reduceat(w, np.arange(0, len(w), POSTINGS_PER_BLOCK)).tolist() for _, w in self.postings]
        self.lists = [(c.tolist(), w.tolist()) for c, w in self.postings]
        n = len(self.chunk_item)
        self.rare, self.aside = np.ones(len(self.postings), dtype=bool), np.zeros(n)
        # The longest lists cost most and weigh least: set aside while no chunk could be reached with them alone.
        for t in sorted(range(len(self.postings)), key=lambda t: (-len(self.postings[t][0]), t)):
            chunks, weights = self.postings[t]
            if (self.aside[chunks] + weights < ASIDE * self.threshold).all():
                self.aside[chunks] += weights
                self.rare[t] = False
        kept = [p if r else (p[0][:0], p[1][:0]) for p, r in zip(self.postings, self.rare, strict=True)]
        self.starts = np.cumsum([0] + [len(c) for c, _ in kept])
        self.chunks = np.concatenate([c for c, _ in kept]) if kept else np.zeros(0, dtype=np.int64)
        self.weights = np.concatenate([w for _, w in kept]) if kept else np.zeros(0)


def chunks_of(text: str | None, passage: int = PASSAGE) -> list[Counter]:
    """The words of each of the text's chunks, counted."""
    words = words_of(text)
    pieces = -(-len(words) // (passage // 2))
    return [Counter(words[len(words) * k // pieces : len(words) * (k + 1) // pieces]) for k in range(pieces)]


@dataclass
class Statistics:
    """Over all items: chunks, words in them, and by term the chunks that hold it (at least for the terms of the index)."""

    chunks: int
    words: int
    frequency: dict[str, int]


def build_index(items: Sequence[tuple], threshold: float = THRESHOLD, passage: int = PASSAGE, over: Statistics | None = None) -> Index:
    """An index of (item_id, text) rows, weighed by the given statistics or else by their own."""
    chunks: list[tuple[int, Counter]] = []
    questions, answers = [], []
    for number, (_, text) in enumerate(items):
        chunks += [(number, c) for c in chunks_of(text, passage)]
        question, answer = question_and_answer(text or "")
        questions.append(runs(words_of(question)))
        answers.append(runs(words_of(answer)))
    over = over or Statistics(len(chunks), sum(c.total() for _, c in chunks), Counter(t for _, c in chunks for t in c))
    frequency = {t: over.frequency[t] for _, c in chunks for t in c}
    mean = over.words / max(1, over.chunks)
    idf = {t: math.log(1 + (over.chunks - n + 0.5) / (n + 0.5)) for t, n in frequency.items()}
    terms = {t: i for i, t in enumerate(sorted(frequency))}
    lists: list[list] = [[] for _ in terms]
    for number, (_, counts) in enumerate(chunks):
        length = K1 * (1 - B + B * counts.total() / mean)
        own = {t: idf[t] * n * (K1 + 1) / (n + length) for t, n in counts.items()}
        whole = math.fsum(own.values())
        for t, w in own.items():
            lists[terms[t]].append((number, w / whole))
    postings = [(np.array([c for c, _ in x], dtype=np.int64), np.array([w for _, w in x])) for x in lists]
    return Index([i for i, _ in items], np.array([n for n, _ in chunks], dtype=np.int64), terms, postings, questions, answers, threshold)


def wand(index: Index, query: Sequence[int]) -> list[tuple[int, float]]:
    """(chunk, score) of all chunks that reach the threshold for the distinct terms of the query."""
    least = index.threshold - SLACK
    cursors = [[index.lists[t][0][0], t, 0] for t in query]  # chunk, term, position
    found = []
    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for k, (_, t, _) in enumerate(cursors):
            bound += index.top[t]
            if bound >= least:
                pivot = k
                break
        if pivot < 0:
            break
        at = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
            pivot += 1
        # The block maxima where the pivot lies, and how far these blocks reach.
        tight, reach = 0.0, None
        for cursor in cursors[: pivot + 1]:
            chunks, t = index.lists[cursor[1]][0], cursor[1]
            block = cursor[2] // POSTINGS_PER_BLOCK
            while (block + 1) * POSTINGS_PER_BLOCK < len(chunks) and chunks[(block + 1) * POSTINGS_PER_BLOCK - 1] < at:
                block += 1
            tight += index.blocks[t][block]
            last = chunks[min((block + 1) * POSTINGS_PER_BLOCK, len(chunks)) - 1]
            reach = last if reach is None else min(reach, last)
        if tight >= least:
            if cursors[0][0] == at:
                score = math.fsum(index.lists[t][1][p] for c, t, p in cursors[: pivot + 1])
                if score >= least:
                    found.append((at, score))
                target = at + 1
            else:
                target = at
        else:
            # No chunk up to the end of the nearest block can reach it, unless the next list joins in.
            target = max(at, reach) + 1
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            target = max(target, at + 1)
        for cursor in cursors[: pivot + 1]:
            chunks = index.lists[cursor[1]][0]
            p = bisect_left(chunks, target, cursor[2])
            cursor[0], cursor[2] = (chunks[p] if p < len(chunks) else -1), p
        cursors = [c for c in cursors if c[0] >= 0]
    return found


def candidate_passages(index: Index, ids: np.ndarray, owner: np.ndarray, passage: int = PASSAGE) -> np.ndarray:
    """Starts of passages that some chunk may reach the threshold in, for term ids (-1: no term) of whole documents in a row."""
    half = passage // 2
    place = np.flatnonzero(ids >= 0)
    place = place[index.rare[ids[place]]]
    if not len(place):
        return place
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    base = first[np.searchsorted(first, place, side="right") - 1]
    # A word lies in the passage that starts in its own half and in the one before.
    start = base + (place - base) // half * half
    term = ids[place]
    start = np.concatenate([start, start - half])
    term, base = np.concatenate([term, term]), np.concatenate([base, base])
    inside = start >= base
    key = np.unique(start[inside] * len(index.postings) + term[inside])
    start, term = key // len(index.postings), key % len(index.postings)
    count = index.starts[term + 1] - index.starts[term]
    at = np.repeat(index.starts[term] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
    pair = np.repeat(start, count) * len(index.chunk_item) + index.chunks[at]
    order = np.argsort(pair, kind="stable")
    pair, weight = pair[order], index.weights[at][order]
    heads = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    sums = np.add.reduceat(weight, heads) + index.aside[pair[heads] % len(index.chunk_item)]
    return np.unique(pair[heads][sums >= index.threshold - SLACK] // len(index.chunk_item))


def matches(index: Index, texts: Sequence[str | None], passage: int = PASSAGE, overlap: float = OVERLAP) -> list[tuple]:
    """(number of the text, item, score, question_overlap, answer_overlap) of every verified match."""
    words = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in words])
    ids = np.fromiter(map(index.terms.get, chain.from_iterable(words), repeat(-1)), dtype=np.int64, count=int(lengths.sum()))
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths)
    best: dict[tuple[int, int], float] = {}
    for start in candidate_passages(index, ids, owner, passage).tolist():
        number = int(owner[start])
        query = np.unique(ids[start : min(start + passage, int(ends[number]))])
        for chunk, score in wand(index, query[query >= 0].tolist()):
            key = (number, int(index.chunk_item[chunk]))
            best[key] = max(best.get(key, 0.0), score)
    out, last, held = [], -1, {}
    for (number, item), score in sorted(best.items()):
        if number != last:
            last, held = number, {}
        shares = [share(part, words[number], held) for part in (index.questions[item], index.answers[item])]
        if min(shares) >= overlap:
            out.append((number, index.items[item], round(score, 9), *shares))
    return out


def _terms_in_blocks(items: DataFrame) -> DataFrame:
    """block, term and in how many of the block's chunks it is; with null for the term, the chunks and words of the block."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            blocks, terms, chunks, words = [], [], [], []
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = chunks_of(text)
                held = Counter(t for c in counts for t in c)
                blocks += [block] * (len(held) + 1)
                terms += [None, *held]
                chunks += [len(counts), *held.values()]
                words += [sum(c.total() for c in counts), *repeat(0, len(held))]
            columns = [pa.array(blocks, pa.int64()), pa.array(terms, pa.string()), pa.array(chunks, pa.int64()), pa.array(words, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "term", "chunks", "words"])

    counted = items.select("block", "text").mapInArrow(count, "block long, term string, chunks long, words long")
    return counted.groupBy("block", "term").agg(F.sum("chunks").alias("chunks"), F.sum("words").alias("words"))


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD) -> Iterator:
    """A broadcast index for each block of items."""
    blocks = -(-benchmark.count() // ITEMS_PER_BLOCK)
    items = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("long").alias("block"))
    if blocks > 1:
        terms = settle(_terms_in_blocks(items))
        chunks, words = terms.where("term IS NULL").agg(F.sum("chunks"), F.sum("words")).first()
        terms = terms.where("term IS NOT NULL")
        everywhere = settle(terms.select("block", "term").join(terms.groupBy("term").agg(F.sum("chunks").alias("n")), "term"))
    for block in range(blocks):
        part = items.where(F.col("block") == block).select("item_id", "text")
        over = None
        if blocks > 1:
            over = Statistics(chunks, words, {r.term: r.n for r in everywhere.where(F.col("block") == block).toLocalIterator()})
        rows = sorted((tuple(r) for r in part.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield benchmark.sparkSession.sparkContext.broadcast(build_index(rows, threshold, over=over))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every document and item it holds."""
    kinds = [docs.select("doc_id").schema[0], benchmark.select("item_id").schema[0]]
    schema = T.StructType([*kinds, *[T.StructField(c, T.DoubleType()) for c in ("score", "question_overlap", "answer_overlap")]])
    arrow = to_arrow_schema(schema)

    def search(index) -> DataFrame:
        def seek(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in frames:
                for at in range(0, whole.num_rows, BATCH_ROWS):
                    batch = whole.slice(at, BATCH_ROWS)
                    found = matches(index.value, batch.column(1).to_pylist(), overlap=overlap)
                    own = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                    rest = [pa.array([f[k] for f in found], arrow.field(k).type) for k in range(1, 5)]
                    yield pa.RecordBatch.from_arrays([own, *rest], arrow.names)

        return docs.select("doc_id", "text").mapInArrow(seek, schema)

    result = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, threshold):
        result = result.unionByName(search(index))
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that hold no item."""
    place = docs.columns.index("text")

    def without(rows: DataFrame, index) -> DataFrame:
        def keep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in frames:
                for at in range(0, whole.num_rows, BATCH_ROWS):
                    batch = whole.slice(at, BATCH_ROWS)
                    clean = np.ones(batch.num_rows, dtype=bool)
                    clean[[f[0] for f in matches(index.value, batch.column(place).to_pylist())]] = False
                    yield batch.filter(pa.array(clean))

        return rows.mapInArrow(keep, rows.schema)

    for index in indexes(benchmark):
        docs = without(docs, index)
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
