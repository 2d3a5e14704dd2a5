"""Packing token sequences by best-fit decreasing.

Documents are tokenized (their end mark last), overlong ones are cut into full windows
and a rest, and the pieces of each partition are packed in decreasing length: a segment
tree over remaining capacities finds the tightest open window. Partitions are dealt
evenly, whatever the ids or copies, and hold a bounded number of pieces, so no task grows
with the input; each leaves a few windows that are not full.

* Null or empty texts are the end mark alone. Null ids and repeated rows are packed like
  any other. Equal lengths: by id, then start. Empty table: no rows.
* Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sitewise.llm.common import parts, table
from sitewise.session import settle

WINDOW = 4096
PIECES_PER_PART = 50_000
WORDS_KEPT = 600_000  # per worker; only speed depends on it
SHORT = 64


class Encoder:
    """Token ids as little-endian bytes. The tokenizer lower-cases, drops white space and treats runs of
    letters alone, so each such word is encoded once and looked up afterwards."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # tokens that end a run
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _fill(self, words: list[str]) -> None:
        """Encode unknown words: those of letters in one go, which the ends of runs cut apart again."""
        letters = [w for w in words if w.isalpha()]
        ids = np.asarray(self.tokenizer.encode(" ".join(letters), add_special_tokens=False).ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        rest = [w for w in words if not w.isalpha()]
        if len(stops) == len(letters):
            data, at = ids.tobytes(), (4 * np.r_[0, stops]).tolist()
            self.known.update((w, data[at[i] : at[i + 1]]) for i, w in enumerate(letters))
        else:
            rest = words
        if rest:
            found = self.tokenizer.encode_batch(rest, add_special_tokens=False)
            self.known.update((w, np.asarray(e.ids, dtype="<u4").tobytes()) for w, e in zip(rest, found, strict=True))

    def encode(self, text: str) -> bytes:
        if not ("<|" in text or "\u03a3" in text) and unicodedata.is_normalized("NFC", text):
            # Elsewhere lower() could make a special token, or differ from the tokenizer's own (sigma).
            text = text.lower()
        words = text.replace("\n", " ").split(" ")
        known = self.known
        new = set(words).difference(known)
        if new:
            if len(known) > WORDS_KEPT:
                known.clear()
                known[""] = b""
                new = set(words) - {""}
            # A stop or comma behind a letter is a run of its own.
            marked = {w for w in new if len(w) > 1 and w[-1] in ".," and w[-2].isalpha()}
            ask = ((new - marked) | {w[:-1] for w in marked} | {w[-1] for w in marked}).difference(known)
            if ask:
                self._fill(list(ask))
            for w in marked:
                known[w] = known[w[:-1]] + known[w[-1]]
            out = b"".join([known[w] for w in words])
            for w in new:
                if len(w) > SHORT:
                    del known[w]
            return out
        return b"".join([known[w] for w in words])


_encoders: dict[str, Encoder] = {}  # one per worker process and vocabulary


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = 2, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids, 32-bit little-endian) of every piece."""
    kind = docs.schema["doc_id"].dataType
    fields = [
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    last = np.asarray([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows: list[list] = [[] for _ in fields]
            at: list[int] = []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + last
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    at.append(i)
                    for column, value in zip(rows[1:], (start, len(piece) // 4, zlib.crc32(piece), n, piece), strict=False):
                        column.append(value)
            arrays = [batch.column(0).take(pa.array(at, pa.int64()))]
            arrays += [pa.array(c, pa.int64()) for c in rows[1:5]] + [pa.array(c, pa.binary()) for c in rows[5:]]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


def best_fit(lengths: Sequence[int], capacity: int) -> list[tuple[int, int]]:
    """(window, offset) for each length, which must be in decreasing order."""
    leaves = 1 << capacity.bit_length()
    tree = [0] * (2 * leaves)  # open windows below each node; leaf c: those with c free
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed, windows = [], 0

    def add(room: int, by: int) -> None:
        node = room + leaves
        while node:
            tree[node] += by
            node >>= 1

    def tightest(need: int) -> int:
        node = need + leaves
        if tree[node]:
            return need
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                while node < leaves:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
                return node - leaves
            node >>= 1
        return -1

    for length in lengths:
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit in {capacity}")
        room = tightest(length)
        if room < 0:
            chosen, room, windows = windows, capacity, windows + 1
        else:
            chosen = free[room].pop()
            add(room, -1)
        placed.append((chosen, capacity - room))
        if room > length:
            free[room - length].append(chosen)
            add(room - length, 1)
    return placed


def pack(pieces: DataFrame, window: int = WINDOW, pieces_per_part: int = PIECES_PER_PART) -> DataFrame:
    """The pieces (doc_id, start, length and whatever else they carry) with sequence_id and offset.

    ``pieces`` is read twice; pass a written table. A sequence id holds its partition in the high half.
    """
    n = parts(pieces, pieces.count(), pieces_per_part)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [f for f in frames if len(f)]
        if not rows:
            return
        rows = pd.concat(rows, ignore_index=True).sort_values(["length", "doc_id", "start"], ascending=[False, True, True], ignore_index=True)
        at = np.asarray(best_fit(rows["length"].tolist(), window), dtype=np.int64)
        rows["sequence_id"] = (TaskContext.get().partitionId() << 32) + at[:, 0]
        rows["offset"] = at[:, 1]
        yield rows

    return pieces.repartition(n).mapInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    return pack(settle(token_pieces(docs, tokenizer, window)), window)


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack_documents(table(spark, sf_dir, "documents"), word_vocabulary())
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
