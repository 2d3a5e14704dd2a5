r"""Fill-in-middle transformation, cut with a learned rank index.

A text is a run of units, ``[A-Za-z]+|[^A-Za-z]``. Unit k ends at a boundary offset (in code
points); a cut after k units needs the offset of rank k. The index of a text is a piecewise
linear model of all its offsets: segments of ranks, each a chord from its first to its last
offset, within ``ERROR`` of every offset between. A segment that is not is halved, until all
are. What the chord is off at each rank is stored as one byte. A cut is predicted from its
segment and corrected by its residual: exact, whatever the text.

Prefix and middle end at ranks drawn from a hash of the document's id; the three parts are
written in one of two orders behind marks, or the text is left plain (see ``forms``). ``restore``
reads the text back from the output and its form.

* Texts are indexed whole, many at a time: short ones together, a long one by itself.
* Null or empty text: no units, plain. A text that holds a mark is plain.
* Null ids are drawn as an id without digits. Repeated rows and equal ids: the same draws, results of their own.
* Empty table: no rows. Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm.common import table

PREFIX, SUFFIX, MIDDLE = MARKS = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ERROR = 127  # code points that a chord may be off: a residual is one byte
FIRST = 1_024  # ranks of a segment before any is halved
GATHER = 1 << 20  # code points indexed together


@dataclass
class RankIndex:
    """Offsets by rank of many texts one after another: ``first[t]`` is rank 0 of text t."""

    first: np.ndarray
    units: np.ndarray
    starts: np.ndarray  # ranks at which segments begin
    base: np.ndarray  # the offset there
    slope: np.ndarray
    residuals: np.ndarray

    def offsets(self, texts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets after ``ranks`` units of the texts: predicted, then corrected."""
        at = self.first[texts] + ranks
        segment = np.searchsorted(self.starts, at, side="right") - 1
        return _predict(self.base[segment], self.slope[segment], at - self.starts[segment]) + self.residuals[at]


def _predict(base: np.ndarray, slope: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    return base + np.rint(slope * ahead).astype(np.int64)


def boundaries(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All boundary offsets, 0 and the end included, text after text, and how many each text has."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    letter = (points | 32) - 97 < 26  # unsigned: what is below "a" wraps around
    ends = np.cumsum(lengths)
    cut = np.ones(len(points) + 1, dtype=bool)
    cut[1:-1] = ~(letter[1:] & letter[:-1])
    cut[ends] = True  # a unit never goes on in the next text
    inner = np.flatnonzero(cut[1:]) + 1  # ends of units, in order
    counts = np.searchsorted(inner, ends, side="right")
    units = np.diff(np.r_[0, counts])
    # Each text's own offsets, behind a 0 for its rank 0.
    own = inner - np.repeat(ends - lengths, units)
    first = np.r_[0, np.cumsum(units + 1)[:-1]]
    offsets = np.zeros(len(own) + len(texts), dtype=np.int64)
    place = np.ones(len(offsets), dtype=bool)
    place[first] = False
    offsets[place] = own
    return offsets, units + 1


def fit(texts: Sequence[str], error: int = ERROR, first_ranks: int = FIRST) -> RankIndex:
    """The index of one or more texts: every offset lies within ``error`` (127 at most) of its segment's chord."""
    if not 0 <= error <= 127:
        raise ValueError("a residual is one byte")
    offsets, counts = boundaries(texts)
    first = np.r_[0, np.cumsum(counts)[:-1]]
    # Segments of first_ranks ranks at most, cut at the texts' ends.
    per_text = -(-counts // first_ranks)
    number = np.arange(per_text.sum()) - np.repeat(np.r_[0, np.cumsum(per_text)[:-1]], per_text)
    starts = np.repeat(first, per_text) + number * first_ranks
    stops = np.minimum(starts + first_ranks, np.repeat(first + counts, per_text))
    residuals = np.empty(len(offsets), dtype=np.int8)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(starts):
        sizes = stops - starts
        base = offsets[starts]
        slope = (offsets[stops - 1] - base) / np.maximum(sizes - 1, 1)
        begin = np.r_[0, np.cumsum(sizes)[:-1]]
        ahead = np.arange(sizes.sum()) - np.repeat(begin, sizes)
        ranks = np.repeat(starts, sizes) + ahead
        off = offsets[ranks] - _predict(np.repeat(base, sizes), np.repeat(slope, sizes), ahead)
        fits = np.maximum.reduceat(np.abs(off), begin) <= error
        kept = np.repeat(fits, sizes)
        residuals[ranks[kept]] = off[kept]
        done.append((starts[fits], base[fits], slope[fits]))
        # Both ends of a chord are exact, so a segment of two ranks always fits.
        left, right = starts[~fits], stops[~fits]
        middle = (left + right) // 2
        starts, stops = np.r_[left, middle], np.r_[middle, right]
    begins, base, slope = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(begins)
    return RankIndex(first, counts - 1, begins[order], base[order], slope[order], residuals)


def draws(doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def form_of(text: str, h: Sequence[int]) -> str:
    if not text or h[2] % 100 >= 90 or any(mark in text for mark in MARKS):
        return PLAIN
    return SPM if h[3] % 100 < 20 else PSM


def written(text: str, form: str, start: int, stop: int) -> str:
    """The text with its middle, ``text[start:stop]``, at the end."""
    if form == PLAIN:
        return text
    if form == PSM:
        return "".join((PREFIX, text[:start], SUFFIX, text[stop:], MIDDLE, text[start:stop]))
    return "".join((SUFFIX, text[stop:], PREFIX, text[:start], MIDDLE, text[start:stop]))


def restore(output: str, form: str) -> str:
    """The text that was written in that form. No text with a mark is cut, so the first of each is the mark."""
    if form == PLAIN:
        return output
    mark = SUFFIX if form == PSM else PREFIX
    one, _, rest = output[len(PREFIX) :].partition(mark)
    two, _, middle = rest.partition(MIDDLE)
    return one + middle + two if form == PSM else two + middle + one


def _gathered(texts: Sequence[str]) -> Iterator[range]:
    """Stretches of texts of about ``GATHER`` code points."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > GATHER:
            yield range(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield range(start, len(texts))


def cut_texts(ids: Sequence[int | None], texts: Sequence[str]) -> Iterator[tuple[int, str, int, int, str]]:
    """Units, form, end of the prefix, end of the middle (code points) and output of each text."""
    for stretch in _gathered(texts):
        some = [texts[i] for i in stretch]
        index = fit(some)
        h = [draws(ids[i]) for i in stretch]
        modulus = index.units + 1
        ranks = np.sort(np.array([x[:2] for x in h], dtype=np.int64) % modulus[:, None], axis=1)
        rows = np.arange(len(some))
        start, stop = (index.offsets(rows, ranks[:, k]).tolist() for k in (0, 1))
        for i, text in enumerate(some):
            form = form_of(text, h[i])
            yield int(index.units[i]), form, start[i], stop[i], written(text, form, start[i], stop[i])


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, start, stop (null where plain) and output of every row."""
    fields = [docs.schema["doc_id"], *(T.StructField(*f) for f in (("n", T.LongType()), ("form", T.StringType()), ("start", T.LongType())))]
    fields += [T.StructField("stop", T.LongType()), T.StructField("output", T.StringType())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows = list(cut_texts(batch.column(0).to_pylist(), texts))
                n, form, start, stop, output = zip(*rows, strict=True)
                plain = [f == PLAIN for f in form]
                places = [pa.array([None if p else x for p, x in zip(plain, xs, strict=True)], pa.int64()) for xs in (start, stop)]
                columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), *places, pa.array(output, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


def restored(rows: DataFrame) -> DataFrame:
    """``form`` and ``output`` rows with ``restored``, the text read back, added."""
    keep = rows.schema.fields
    form, output = rows.columns.index("form"), rows.columns.index("output")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(output).to_pylist(), batch.column(form).to_pylist(), strict=True)
            texts = pa.array([restore(o, f) for o, f in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*(f.name for f in keep), "restored"])

    return rows.mapInArrow(read, T.StructType([*keep, T.StructField("restored", T.StringType())]))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.col("start").alias("prefix_chars"),
        (F.col("stop") - F.col("start")).alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), d AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(a, b)], '') AS prefix,
         array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(units[greatest(a, b) + 1:n], '') AS suffix
  FROM d
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
