r"""Toxic spans by a conditional random field, and document scores from its marginals.

Training takes a bounded sample of labelled documents (``TRAIN_ROWS``). Words and word
beginnings that are much more frequent in toxic documents are the features; a training
token is labelled toxic if its document is and it has a strong feature. The field is run on
windows of words around tokens with features (elsewhere no token has any); forward-backward
marginals give offending spans (code points) and, through a logistic model fitted on the
same sample, a score for the whole document.

* Null or empty text: the score of a document without any toxic token.
* No document of one of the labels: nothing can be learnt. Every score is the smoothed share of toxic ones, kept
  below 0.5, so nothing is called toxic and no row is dropped.
* Null ids are scored; they are never training rows. Labels of repeated or unknown ids:
  each pair of row and label counts; null labels do not.
* Only the text is an input of a score. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm.common import table
from sitewise.llm.crf import Chain

TRAIN_ROWS = 6_000
BEGINNINGS = (4, 5, 6, 7)
SLOTS = 1 + len(BEGINNINGS)
MIN_DOCS, WEAK, STRONG = 5, 2.0, 2.5  # documents, log odds of a feature, log odds that label a token
AROUND = 2
WORDS_KEPT = 500_000
NEVER = 0.499  # the highest score where one of the labels was never seen
WORD = re.compile(r"\w+")
BATCH_ROWS = 256


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def _features(word: str) -> list[str]:
    return ["=" + word, *[word[:n] if len(word) >= n else "" for n in BEGINNINGS]]


@dataclass
class ToxicModel:
    ids: dict[str, int]
    chain: Chain | None
    logistic: np.ndarray
    scale: np.ndarray

    def __post_init__(self):
        self.kept: dict[str, np.ndarray | None] = {}

    def __getstate__(self):
        return {"ids": self.ids, "chain": self.chain, "logistic": self.logistic, "scale": self.scale}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.kept = {}

    def slots(self, word: str) -> np.ndarray | None:
        """The feature ids of a lower-case word, None if it has none."""
        at = [self.ids.get(f, 0) for f in _features(word)]
        return np.array(at) if any(at) else None

    def windows(self, text: str) -> tuple[list[np.ndarray], list[list[tuple[int, int]]]]:
        """Feature ids of the words around each word with features, and their places in the text."""
        low = text.lower()
        pieces = low.split()
        kept = self.kept  # for what stands between blanks: whether any word in it has features
        if len(kept) > WORDS_KEPT:
            kept.clear()
        for w in set(pieces).difference(kept):
            kept[w] = any(self.slots(p) is not None for p in WORD.findall(w))
        if not any(map(kept.__getitem__, pieces)):
            return [], []
        # Places are those in the text itself, also where lower() changes its length.
        found = list(WORD.finditer(text))
        words = [m[0].lower() for m in found]
        known = {w: self.slots(w) for w in set(words)}
        slots = [known[w] for w in words]
        hot = [i for i, s in enumerate(slots) if s is not None]
        none = np.zeros(SLOTS, dtype=np.int64)
        ids, places, start = [], [], 0
        while start < len(hot):
            stop = start
            while stop + 1 < len(hot) and hot[stop + 1] - hot[stop] <= 2 * AROUND:
                stop += 1
            span = range(max(0, hot[start] - AROUND), min(len(found), hot[stop] + AROUND + 1))
            ids.append(np.array([none if slots[i] is None else slots[i] for i in span]))
            places.append([found[i].span() for i in span])
            start = stop + 1
        return ids, places

    def judge(self, texts: Sequence[str]) -> list[tuple[float, list[tuple[int, int, float]]]]:
        """(score, spans with probability) of each text."""
        inputs, spans = self.tag(texts)
        return list(zip(sigmoid(inputs / self.scale @ self.logistic).tolist(), spans, strict=True))

    def tag(self, texts: Sequence[str]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """What the document model sees of each text, and its spans."""
        sequences, places, owner = [], [], []
        for i, text in enumerate(texts):
            ids, at = self.windows(text) if self.chain is not None else ([], [])
            sequences += ids
            places += at
            owner += [i] * len(ids)
        sums = np.zeros((len(texts), 3))
        spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
        for i, at, share in zip(owner, places, self.chain.marginals(sequences) if sequences else [], strict=True):
            toxic = share[:, 1]
            sums[i] += (toxic.sum(), 0, (toxic > 0.5).sum())
            sums[i, 1] = max(sums[i, 1], toxic.max())
            spans[i] += [(a, b, float(p)) for (a, b), p in zip(at, toxic, strict=True) if p > 0.5]
        return document_inputs(sums, np.array([len(t) for t in texts])), spans


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def document_inputs(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What the document model sees: marginals summed, highest, counted over one half, and per length."""
    total, most, count = sums.T
    per = 200 * total / (lengths + 200)
    return np.stack([np.ones(len(sums)), np.log1p(total), most, np.log1p(count), np.log1p(per)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ beta)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def train(rows: Sequence[tuple[str | None, int]]) -> ToxicModel:
    """A model from (text, label) rows, in any order: the result does not depend on it."""
    rows = sorted((t or "", int(y)) for t, y in rows)
    counts = [Counter(), Counter()]
    docs = [sum(1 - y for _, y in rows), sum(y for _, y in rows)]
    for text, y in rows:
        counts[y].update({f for w in set(WORD.findall(text.lower())) for f in _features(w) if f})
    if not all(docs):
        share = (docs[1] + 0.5) / (sum(docs) + 1)
        share = min(share, NEVER)
        return ToxicModel({}, None, np.array([math.log(share / (1 - share)), 0, 0, 0, 0]), np.ones(5))
    odds = {
        f: math.log((n + 0.5) / (docs[1] + 1)) - math.log((counts[0][f] + 0.5) / (docs[0] + 1)) for f, n in counts[1].items() if n >= MIN_DOCS
    }
    chosen = sorted(f for f, o in odds.items() if o >= WEAK)
    model = ToxicModel({f: i + 1 for i, f in enumerate(chosen)}, None, np.zeros(5), np.ones(5))
    strong = np.array([False] + [odds[f] >= STRONG for f in chosen])
    sequences, labels = [], []
    for text, y in rows:
        for ids in model.windows(text)[0]:
            sequences.append(ids)
            labels.append((strong[ids].any(axis=1) & (y == 1)).astype(np.int64))
    model.chain = Chain.fit(sequences, labels, len(chosen) + 1, 2)
    inputs = np.concatenate([model.tag([t for t, _ in rows[at : at + BATCH_ROWS]])[0] for at in range(0, len(rows), BATCH_ROWS)])
    model.scale = np.maximum(np.abs(inputs).max(axis=0), 1e-9)
    model.logistic = fit_logistic(inputs / model.scale, np.array([y for _, y in rows], dtype=float))
    return model


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> list[tuple[str | None, int]]:
    """About ``limit`` labelled rows that are not held out, chosen by a hash of the id."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    n = usable.count()
    drawn = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 20)) < int(limit / max(1, n) * (1 << 20)) + 1)
    rows = docs.select("doc_id", "text").join(drawn, "doc_id").select("text", "toxic").limit(2 * limit).toPandas()
    return list(rows.itertuples(index=False, name=None))


def score_documents(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score and spans (start, stop in code points, probability) of every row."""
    spark = docs.sparkSession
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("probability", T.DoubleType())])
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]
    )
    shared = spark.sparkContext.broadcast(model)  # bounded by the training sample
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("probability", pa.float64())]))

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in frames:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                found = own.judge([t or "" for t in batch.column(1).to_pylist()])
                spans = pa.array([[dict(zip(("start", "stop", "probability"), s, strict=True)) for s in x[1]] for x in found], arrow)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.float64()), spans], ["doc_id", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(score, schema)


def drop_toxic(docs: DataFrame, model: ToxicModel, limit: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text scores below the limit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def keep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in frames:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                found = shared.value.judge([t or "" for t in batch.column(place).to_pylist()])
                yield batch.filter(pa.array([score < limit for score, _ in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(training_rows(docs, table(spark, sf_dir, "labels"))))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))).alias("spans"),
    )
