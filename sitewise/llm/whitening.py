r"""Embedding whitening from the singular values of the centred rows.

No covariance is formed. Tasks reduce blocks of centred rows to triangles by QR, and triangles to
one (``reduce_rows``); its Householder bidiagonal form has the same singular values, which the
differential quotient-difference algorithm with shifts (dqds) finds to high relative accuracy,
small ones too. A direction of the bidiagonal form comes from the twisted factorisation of its
square, shifted by the singular value's square: from the row where top-down and bottom-up
elimination leave the least, the vector is solved for upwards and downwards. Directions of values
that lie close together are made orthogonal to each other. Householder's reflections take them back.

* Rows are fitted as whole numbers, ``floor(256 * c)`` of each entry; equal vectors count once. Rows with a
  null vector, or a null or non-finite entry, are left out, and vectors of another length than
  most distinct vectors have (ties: the longer). Empty vectors have no components.
* Components whose variance is zero to working precision are left out: there are as many as the
  vectors span, four at most. No row left, or all vectors equal: no rows.
* Null ids and repeated rows are whitened like any other. Other columns are ignored, whatever their names.
* An entry beyond 2**53 / 256, or a deviation beyond a long, is an error: neither could be exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm.common import table
from sitewise.session import release, settle

COMPONENTS = 4
SCALE = 256
BLOCK = 4_096  # rows of one QR step
JOINED = 8  # partial results that one task, or in the end the driver, joins
EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny


# ---------------------------------------------------------------- singular values and directions


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Diagonal and upper diagonal of Householder's bidiagonal form of a square matrix, and the
    function that takes right directions of that form back to those of the matrix."""
    a = np.array(r, dtype=float)
    d = len(a)
    right: list[np.ndarray] = []

    def reflector(x: np.ndarray) -> np.ndarray:
        v = x.copy()
        size = np.linalg.norm(x)
        if size:
            v[0] += np.copysign(size, x[0])
            v /= np.linalg.norm(v)
        return v

    for k in range(d):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d:
            w = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            right.append(w)

    def back(z: np.ndarray) -> np.ndarray:
        z = z.copy()
        for k in range(len(right) - 1, -1, -1):
            z[k + 1 :] -= 2 * np.outer(right[k], right[k] @ z[k + 1 :])
        return z

    return np.diag(a).copy(), np.diag(a, 1).copy(), back


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform, with the least of its differences; None if the shift was above the least value."""
    new_q, new_e = [], []
    d = least = q[0] - shift
    for i, x in enumerate(e):
        if d < 0:
            return None
        new_q.append(d + x)
        t = q[i + 1] / (d + x)
        new_e.append(x * t)
        d = d * t - shift
        least = min(least, d)
    return None if d < 0 else ([*new_q, d], new_e, least)


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The squared singular values of an upper bidiagonal matrix, falling, by dqds."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    found = _values((diagonal / scale) ** 2, (upper / scale) ** 2)
    return np.sort(np.array(found))[::-1] * scale**2


def _values(squares: Sequence[float], upper_squares: Sequence[float]) -> list[float]:
    q, e = list(map(float, squares)), list(map(float, upper_squares))
    found: list[float] = []
    total, guess = 0.0, 0.0  # the shifts so far, the next one
    while len(q) > 1:
        split = [i for i, x in enumerate(e) if x <= EPS * EPS * (total + q[i]) or x <= TINY]
        if split:  # two matrices that have nothing to do with each other any more
            i = split[-1]
            found += [total + x for x in _values(q[i + 1 :], e[i + 1 :])]
            q, e = q[: i + 1], e[:i]
            continue
        if q[0] < 0.25 * q[-1]:  # the small values to the end
            q, e = q[::-1], e[::-1]
        for shift in (guess, 0.5 * guess, 0.125 * guess, 0.0):  # a shift above the least value fails; none never does
            done = _step(q, e, shift)
            if done is not None:
                break
        q, e, least = done
        total += shift
        # The least value is no more than least; the last two rows tell where it is once they stand nearly alone.
        corner = _least_of_two(q[-2], e[-1], q[-1])
        alone = len(e) == 1 or e[-2] <= 0.01 * corner
        guess = max(0.0, min(0.98 * least, 0.99 * corner if alone else corner - e[-1]))
    return [*found, *(total + x for x in q)]


def _least_of_two(q: float, e: float, last: float) -> float:
    """The lesser eigenvalue of the square of a two-row bidiagonal matrix."""
    half, rest = 0.5 * (q + e + last), q * last
    root = np.sqrt(max(0.0, half * half - rest))
    return rest / (half + root) if half + root else 0.0


def _twisted(diagonal: np.ndarray, upper: np.ndarray, value: float, skip: set[int]) -> tuple[np.ndarray, int]:
    """A unit vector for a squared singular value, twisted at the best row that is not in ``skip``."""
    d = len(diagonal)
    lift = TINY / EPS  # for what is zero; the matrix has entries up to 1
    a = np.where(diagonal == 0, np.sqrt(lift), diagonal)
    safe, low = a**2, upper / a[:-1]  # the square as L Q L', Q the squared diagonal
    # Top-down: L Q L' - value = L+ D+ L+'.
    plus, s = np.empty(max(d - 1, 0)), np.empty(d)
    s[0] = -value
    for i in range(d - 1):
        pivot = s[i] + safe[i]
        pivot = pivot if pivot else lift
        plus[i] = safe[i] * low[i] / pivot
        s[i + 1] = plus[i] * low[i] * s[i] - value
    # Bottom-up: L Q L' - value = U- D- U-'.
    minus, p = np.empty(max(d - 1, 0)), np.empty(d)
    p[d - 1] = safe[d - 1] - value
    for i in range(d - 2, -1, -1):
        pivot = safe[i] * low[i] ** 2 + p[i + 1]
        pivot = pivot if pivot else lift
        minus[i] = safe[i] * low[i] / pivot
        p[i] = p[i + 1] * safe[i] / pivot - value
    gamma = np.abs(s + p + value)
    order = [i for i in np.argsort(gamma, kind="stable") if i not in skip]
    r = int(order[0])
    z = np.zeros(d)
    z[r] = 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(r - 1, -1, -1):
            z[i] = -plus[i] * z[i + 1]
        for i in range(r, d - 1):
            z[i + 1] = -minus[i] * z[i]
    size = np.abs(z).max()
    z = z / size if np.isfinite(size) else np.eye(d)[r]
    return z / np.linalg.norm(z), r


def directions(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Right singular vectors, one column each, of the first n of the (falling) squared singular values."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    diagonal, upper, values = diagonal / scale, upper / scale, values / scale**2
    out: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    used: set[int] = set()
    for k in range(n):
        if k and values[k - 1] - values[k] > 1e-3 * values[k - 1]:
            cluster, used = [], set()
        # Values that agree to many digits share a space: another twist gives another vector of it.
        while True:
            z, r = _twisted(diagonal, upper, values[k], used)
            own = z.copy()
            for _ in range(2):
                for c in cluster:
                    own -= (c @ own) * c
            size = np.linalg.norm(own)
            used = used | {r} if size < 0.1 else used
            if size >= 0.1 or len(used) == len(diagonal):
                break
        z = own / size
        cluster.append(z)
        out.append(z)
    return _refined(diagonal, upper, np.stack(out, axis=1))


def _refined(diagonal: np.ndarray, upper: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The directions within the space they span (Ritz): what mixing of close ones is left is taken out."""
    z, _ = np.linalg.qr(z)
    image = diagonal[:, None] * z
    image[:-1] += upper[:, None] * z[1:]
    _, _, turn = np.linalg.svd(image, full_matrices=False)
    return z @ turn.T


# ---------------------------------------------------------------- vectors as rows


def _usable(column: Column) -> Column:
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return column.isNotNull() & ~bad


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest whole-number type that holds it, the type first: equal rows, equal bytes."""
    low, high = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
    width = np.select([(low >= -(2**b)) & (high < 2**b) for b in (7, 15, 31)], [1, 2, 4], 8)
    out: list[bytes] = [b""] * len(x)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        data = x[rows].astype(f"<i{w}").tobytes()
        step = int(w) * x.shape[1]
        for k, i in enumerate(rows):
            out[i] = bytes([w]) + data[k * step : (k + 1) * step]
    return out


def _unpacked(rows: list[bytes], d: int) -> np.ndarray:
    x = np.empty((len(rows), d), dtype=np.int64)
    widths = np.array([r[0] for r in rows])
    for w in np.unique(widths):
        place = np.flatnonzero(widths == w)
        x[place] = np.frombuffer(b"".join(rows[i][1:] for i in place), dtype=f"<i{w}").reshape(len(place), d)
    return x


def _whole_numbers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x) of the vectors of each length in a batch."""
    lengths = vectors.value_lengths().to_numpy()
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float)
        x = np.floor(SCALE * flat)
        if len(x) and np.abs(x).max() > 2**53:
            raise ValueError("an entry is too large to be exact")
        yield rows, x.astype(np.int64).reshape(len(rows), d)


def fit_list(rows: DataFrame) -> tuple[DataFrame, int]:
    """The distinct vectors (``x``, packed; stored) of the commonest length, and that length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _whole_numbers(batch.column(0)):
                columns = [pa.array([x.shape[1]] * len(x), pa.int32()), pa.array(_packed(x), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["d", "x"])

    fit = settle(rows.select("vector").mapInArrow(pack, "d int, x binary").distinct())
    common = fit.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    d = 0 if common is None else common["d"]
    return fit.where(F.col("d") == d).select("x"), d


def _gathered(rows: DataFrame, d: int, start: Callable[[], tuple], take: Callable[[tuple, np.ndarray], tuple], join: Callable[[tuple, tuple], tuple]) -> tuple:
    """A value (a tuple of arrays) over all rows: taken in blocks inside tasks, then joined, ``JOINED`` at a time."""

    def write(value: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(a.tobytes() for a in value)], pa.binary())], ["value"])

    blank = start()

    def read(data: bytes) -> tuple:
        out, at = [], 0
        for a in blank:
            out.append(np.frombuffer(data, dtype=a.dtype, count=a.size, offset=at).reshape(a.shape))
            at += a.nbytes
        return tuple(out)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = start()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                value = take(value, _unpacked(batch.column(0).slice(at, BLOCK).to_pylist(), d))
        yield write(value)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = start()
        for batch in batches:
            for data in batch.column(0).to_pylist():
                value = join(value, read(data))
        yield write(value)

    values = settle(rows.select("x").mapInArrow(inside, "value binary"))
    n = values.count()
    while n > JOINED:
        n = -(-n // JOINED)
        fewer = settle(values.repartition(n).mapInArrow(joined, "value binary"))
        release(values)
        values = fewer
    value = start()
    for row in values.collect():
        value = join(value, read(bytes(row["value"])))
    release(values)
    return value


def moments(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums: as high and low halves, right up to some 10**12 vectors."""

    def join(a, b):
        low = a[2] + b[2]
        return a[0] + b[0], a[1] + b[1] + (low >> 30), low & (2**30 - 1)

    def take(value, x):
        return join(value, (len(x), (x >> 30).sum(axis=0), (x & (2**30 - 1)).sum(axis=0)))

    def start():
        return np.zeros(1, np.int64), np.zeros(d, np.int64), np.zeros(d, np.int64)

    n, high, low = _gathered(fit, d, start, take, join)
    return int(n[0]), [(int(h) << 30) + int(v) for h, v in zip(high, low, strict=True)]


def reduce_rows(fit: DataFrame, d: int, mean: np.ndarray) -> np.ndarray:
    """The triangle R of the centred rows: R'R is the sum of their products."""

    def onto(r: np.ndarray, more: np.ndarray) -> np.ndarray:
        new = np.linalg.qr(np.concatenate([r, more]), mode="r")
        return np.concatenate([new, np.zeros((d - len(new), d))])

    return _gathered(fit, d, lambda: (np.zeros((d, d)),), lambda r, x: (onto(r[0], x - mean),), lambda a, b: (onto(a[0], b[0]),))[0]


def spread(fit: DataFrame, d: int, mean: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The covariance of the vectors' images, centred before multiplying."""
    k = to.shape[1]

    def join(a, b):
        n = a[0] + b[0]
        gap = b[1] - a[1]
        return n, a[1] + gap * b[0] / np.maximum(n, 1), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / np.maximum(n, 1))

    def take(value, x):
        w = (x - mean) @ to
        centre = w.mean(axis=0)
        return join(value, (np.array([float(len(w))]), centre, (w - centre).T @ (w - centre)))

    n, _, products = _gathered(fit, d, lambda: (np.zeros(1), np.zeros(k), np.zeros((k, k))), take, join)
    return products / max(n[0], 1)


@dataclass
class Whitening:
    """A fitted map: n distinct vectors with the sums; per component a direction and a variance, and its share of all."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ (self.directions / np.sqrt(self.variances))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n x - S)**2 of each row, exact."""
        far = self.n * max(1, int(np.abs(x).max(initial=0))) + max(map(abs, self.sums), default=0)
        if len(self.sums) * far * far < 2**63:
            return ((self.n * x - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1)
        return np.array([sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()], dtype=np.int64)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors among the rows; None where no component has a variance."""
    fit, d = fit_list(rows)
    n, sums = moments(fit, d) if d else (0, [])
    found = None
    if n > 1:
        mean = np.array([s / n for s in sums])
        diagonal, upper, back = bidiagonal(reduce_rows(fit, d, mean))
        squares = squared_singular_values(diagonal, upper)
        k = int((squares[:components] > (d * EPS) ** 2 * max(squares[0], TINY)).sum())
        if k:
            to = back(directions(diagonal, upper, squares, k))
            found = Whitening(n, sums, to, squares[:k] / n, squares[:k] / squares.sum(), 0.0)
            found.identity_error = float(np.abs(spread(fit, d, mean, to / np.sqrt(found.variances)) - np.eye(k)).max())
    release(fit)
    return found


def vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (of floats or doubles) of the rows that can be used."""
    vector = F.col("embedding")
    if not isinstance(embeddings.schema["embedding"].dataType.elementType, (T.FloatType, T.DoubleType)):
        vector = vector.cast("array<double>")
    return embeddings.where(_usable(vector)).select("vec_id", vector.alias("vector"))


def whiten(embeddings: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error for every usable row and component."""
    spark = embeddings.sparkSession
    schema = T.StructType(
        [embeddings.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType())]
        + [T.StructField("deviation", T.LongType())]
        + [T.StructField(name, T.DoubleType()) for name in ("whitened", "explained", "identity_error")]
    )
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)  # as many numbers as components and dimensions

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        k = len(own.variances)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                for rows, x in _whole_numbers(batch.column(1)):
                    if x.shape[1] != len(own.sums):
                        continue
                    each = np.repeat(rows, k)
                    columns = [
                        batch.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(each), own.n, dtype=np.int64)),
                        pa.array(np.repeat(own.deviations(x), k)),
                        pa.array(own.whiten(x).ravel()),
                        pa.array(np.tile(own.explained, len(rows))),
                        pa.array(np.full(len(each), own.identity_error)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    return vectors(embeddings).mapInArrow(apply, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return whiten(embeddings, fit_whitening(vectors(embeddings)))
