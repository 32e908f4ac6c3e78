"""Whitening of embeddings by the leading components of their covariance.

Vectors become integers, x = floor(64 c) + 1000000, and the fit list holds each distinct
one once. Its size n and sums S come from one aggregation of long integers. The covariance
is summed over the fit list centred: each task subtracts S / n, the whole part as integers,
and adds up products; the tasks' matrices meet entry by entry in a grouped sum. What the driver
holds is that matrix, of dimensions times dimensions and whatever the number of rows.

There it is reduced to a tridiagonal one by Householder reflections. Its leading
eigenvalues are enclosed by bisection, with Sturm counts that tell how many lie below a
number. Inverse iteration on the tridiagonal matrix gives their vectors; those of eigenvalues
close to each other are made orthogonal within their cluster again after each step. The
reflections, in reverse, turn them into components of the covariance, which are broadcast:
every row is projected where it lies, without a shuffle.

Edge cases: rows whose vector is null, or holds null or non-finite entries, are dropped;
so are those whose length is not the most frequent one (the longer, if two are). An empty
vector that is of that length has no components, hence no rows. Entries beyond 2^46 are cut
to it. Rows with a null id, or that repeat one, are rows of their own; repeated vectors
count once for the fit. Directions without variance, as there are with fewer distinct
vectors than dimensions, have no component, since nothing can be scaled there; with one
distinct vector there are no rows at all. A deviation that no long holds is null. An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import field
from tablecheck.llm.common import rows_of, stored

SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 46)
EPS = np.finfo(float).eps


@dataclass
class Whitening:
    """What the rows are projected with."""

    n: int
    sums: list[int]
    #: eigenvalues, falling, and their unit vectors as columns
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; none if a long can't hold it."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        away = x - whole
        reach = int(np.abs(away).max(initial=0)) + 1
        if (self.n * reach) ** 2 * x.shape[1] < 1 << 63:
            rest = np.array([s % self.n for s in self.sums], np.int64)
            return ((away * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = [
            sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()
        ]
        return [v if v < 1 << 63 else None for v in exact]


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of a symmetric matrix."""
    a, mirrors = matrix.astype(float).copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        size = np.abs(v).max()
        norm = size * np.linalg.norm(v / size) if size else 0.0
        if norm == 0.0 or not np.any(v[1:]):
            mirrors.append(np.zeros(len(v)))
            continue
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = a[k, k + 1 :] = a[k + 1 :, k] - 2 * v * (v @ a[k + 1 :, k])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each number, by Sturm."""
    tiny = EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0)) * EPS or EPS
    below, q = np.zeros(len(at), int), np.full(len(at), np.inf)
    for i in range(len(diagonal)):
        q = diagonal[i] - at - (off[i - 1] ** 2 if i else 0.0) / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no number lies between."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    pad = 4 * EPS * max(abs(low[0]), abs(high[0]))
    low, high = low - pad, high + pad
    wanted = d - np.arange(k)  # so many eigenvalues are not above the i-th largest
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = counts_below(diagonal, off, middle) >= wanted
        high = np.where(above, middle, high)
        low = np.where(above, low, middle)
    return (low + high) / 2


def solved(diagonal: np.ndarray, off: np.ndarray, right: np.ndarray, tiny: float) -> np.ndarray:
    """The solution of a tridiagonal system, by elimination with exchange of rows."""
    d = len(diagonal)
    rows = [[diagonal[i], off[i] if i < d - 1 else 0.0, 0.0] for i in range(d)]
    b = right.tolist()
    for i in range(d - 1):
        below = [off[i], rows[i + 1][0], rows[i + 1][1]]
        if abs(below[0]) > abs(rows[i][0]):
            rows[i], below = below, rows[i]
            b[i], b[i + 1] = b[i + 1], b[i]
        pivot = rows[i][0] if abs(rows[i][0]) > tiny else tiny
        rows[i][0] = pivot
        f = below[0] / pivot
        rows[i + 1] = [below[1] - f * rows[i][1], below[2] - f * rows[i][2], 0.0]
        b[i + 1] -= f * b[i]
    out = [0.0] * (d + 2)
    for i in range(d - 1, -1, -1):
        pivot = rows[i][0] if abs(rows[i][0]) > tiny else tiny
        out[i] = (b[i] - rows[i][1] * out[i + 1] - rows[i][2] * out[i + 2]) / pivot
    return np.array(out[:d])


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors of the eigenvalues, as columns, by inverse iteration."""
    d, rng = len(diagonal), np.random.default_rng(0)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0))
    tiny, out, first, shift = EPS * norm or EPS, np.zeros((d, len(values))), 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j  # a new cluster
        # equal eigenvalues are kept apart, or their vectors would start alike
        shift = min(value, shift - 10 * tiny) if j > first else value
        v = rng.uniform(-1, 1, d)
        for _ in range(5):
            v = solved(diagonal - shift, off, v / np.abs(v).max(), tiny)
            v /= np.abs(v).max()
            for _ in range(2):
                v -= out[:, first:j] @ (out[:, first:j].T @ v)
            v /= np.linalg.norm(v)
        out[:, j] = v
    return out


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues above rounding and their vectors, as columns."""
    d = len(matrix)
    diagonal, off, mirrors = tridiagonal(matrix)
    values = leading_values(diagonal, off, min(k, d))
    values = values[values > 16 * d * EPS * max(values.max(initial=0.0), 0.0)]
    vectors = leading_vectors(diagonal, off, values)
    for at in range(len(mirrors) - 1, -1, -1):
        v = mirrors[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    return values, vectors


def integer_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (id, x): the usable vectors as long integers."""
    c = F.col("c")
    usable = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows_of(df, id=field(id_col), c=field(vector_col).cast("array<double>"))
    rows = rows.where(c.isNotNull() & usable)
    size = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    scaled = F.transform(
        "c",
        lambda v: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), SCALE * v))) + OFFSET,
    )
    rows = rows.where(F.size("c") == (size["d"] if size else 0))
    return rows.select("id", scaled.cast("array<long>").alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(fit: DataFrame, products) -> np.ndarray:
    """The sum of square matrices that ``products`` makes of vectors, entry by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                more = products(_matrix(batch.column("x")))
                total = more if total is None else total + more
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                ["i", "row"],
            )

    parts = fit.mapInArrow(run, "i int, row array<double>")
    rows = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    entries = rows.collect()
    out = np.zeros((max(r["i"] for r in entries) + 1, max(r["j"] for r in entries) + 1))
    for row in entries:
        out[row["i"], row["j"]] = row["v"]
    return out


def fit_whitening(rows: DataFrame, k: int = 16) -> Whitening | None:
    """The whitening of integer rows, or None where there is nothing to fit."""
    fit = stored(rows.select("x").distinct(), "whitening-fit")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            n += batch.num_rows
            if batch.num_rows:
                total = total + _matrix(batch.column("x")).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([[n, *total.tolist()]], pa.list_(pa.int64()))], ["s"])

    parts = fit.mapInArrow(sums, "s array<long>").select(F.posexplode("s").alias("j", "s"))
    found = {r["j"]: int(r["s"]) for r in parts.groupBy("j").agg(F.sum("s").alias("s")).collect()}
    if len(found) < 2:
        return None
    model = Whitening(found[0], [found[j] for j in range(1, len(found))], np.zeros(0), np.zeros(0), 0.0)

    def squares(x: np.ndarray) -> np.ndarray:
        z = model.centred(x)
        return z.T @ z

    covariance = _summed(fit, squares) / model.n
    covariance = (covariance + covariance.T) / 2
    model.trace = float(np.trace(covariance))
    model.values, model.components = leading(covariance, k)
    if not len(model.values):
        return None
    means = _summed(fit, lambda x: model.project(x).sum(axis=0, keepdims=True))[0] / model.n

    def white(x: np.ndarray) -> np.ndarray:
        w = model.project(x) - means
        return w.T @ w

    off = _summed(fit, white) / model.n - np.eye(len(model.values))
    model.identity_error = float(np.abs(off).max())
    return model


def whiten(
    df: DataFrame, k: int = 16, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error).

    One row for each usable vector and component, the components from 1 by falling
    eigenvalue.
    """
    rows = stored(integer_rows(df, id_col, vector_col), "whitening-rows")
    model = fit_whitening(rows, k)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096) if model else ():
                part = batch.slice(at, 4096)
                x = _matrix(part.column("x"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(model.deviations(x), pa.int64()),
                        pa.array(model.project(x).tolist(), pa.list_(pa.float64())),
                    ],
                    ["id", "deviation", "white"],
                )

    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("deviation", T.LongType()),
            T.StructField("white", T.ArrayType(T.DoubleType())),
        ]
    )
    shares = F.lit([float(v) / model.trace for v in model.values] if model else [0.0])
    return (
        rows.mapInArrow(run, schema)
        .select("id", "deviation", F.posexplode("white").alias("at", "whitened"))
        .select(
            F.col("id").alias("vec_id"),
            (F.col("at") + 1).alias("component"),
            F.lit(model.n if model else 0).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("at")).alias("explained"),
            F.lit(model.identity_error if model else 0.0).alias("identity_error"),
        )
    )
