"""Whitening of embeddings by their leading components, found by spectrum slicing.

1. An entry c becomes the whole number x = floor(64 c) + 1000000. The fit list holds
   each distinct vector once (a hash aggregate, so that a vector that a third of all
   rows share costs a row a task). Its number, its sums and then its covariance, centred
   before multiplying, are added up by task.
2. The covariance, a matrix of the dimension, comes to the driver. How many of its
   eigenvalues lie above a shift is the number of positive pivots of the LDLᵀ
   factorisation of the shifted matrix. Such counts bisect the line until each leading
   eigenvalue has an interval of its own (or a cluster one of rounding's width); Rayleigh
   quotient iteration within the interval then triples the right digits a step, its
   factorisations narrowing the interval further; counts on both sides of the result
   certify its number. Vectors of a cluster are made orthogonal to those before.
3. Rows are projected where they lie; the whitened fit list's covariance is measured
   by one more pass.

Rows are left out whose vector is null, holds a null or non-finite entry, or an entry of
2^46 or more (x would leave the numbers that a double holds exactly), or whose length is
not the table's dimension, the commonest length (the greater of equals). Components whose
variance is nothing but rounding are left out: equal vectors have none, so that a table
of one distinct vector, like an empty one, gives no rows. Repeated rows are returned each.
A deviation beyond 64 bits is NULL. Only the id and the vector are read, whatever other
columns there are; the id may have any type and be null. Memory grows with the square of
the dimension and not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import ready, stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**46
EPS = float(np.finfo(np.float64).eps)
#: Low bits of the numbers that are added apart from the high ones.
LOW = 24
#: Partial matrices that are added in one group.
TOGETHER = 256


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that can be used, their lengths, floor(64 c) of their entries) of a list column."""
    rows = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    kept = vectors.take(pa.array(rows))
    offsets = kept.offsets.to_numpy().astype(np.int64)
    entries = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    # A null entry arrives as NaN.
    bad = np.concatenate(([0], np.cumsum(~(np.abs(entries) < LARGEST))))
    offsets = offsets - offsets[0]
    fine = bad[offsets[1:]] == bad[offsets[:-1]]
    lengths = np.diff(offsets)
    x = np.floor(SCALE * entries[np.repeat(fine, lengths)]).astype(np.int64)
    return rows[fine], lengths[fine], x


def encoded(x: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The rows' numbers as bytes, in the narrowest width that holds a row: equal rows, equal bytes."""
    ends = np.cumsum(lengths)
    out = []
    for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True):
        row = x[a:b]
        most = int(np.abs(row).max()) if b > a else 0
        out.append(row.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes())
    return out


def decoded(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors x of a column of `encoded` rows."""
    sizes = pc.binary_length(column).to_numpy()
    out = np.empty((len(column), dimension), np.int64)
    for width in (2, 4, 8):
        rows = np.flatnonzero(sizes == width * dimension)
        if len(rows):
            chosen = column if len(rows) == len(column) else column.take(pa.array(rows))
            out[rows] = np.frombuffer(b"".join(chosen.to_pylist()), f"<i{width}").reshape(-1, dimension)
    return out + SHIFT


def usable(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, dimension, x) of the rows that can be used, of any length."""
    ready(table.sparkSession)
    source = table.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))

    def run(batches):
        for batch in batches:
            rows, lengths, x = whole_numbers(batch.column("vector"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(rows)),
                    pa.array(lengths, pa.int32()),
                    pa.array(encoded(x, lengths), pa.binary()),
                ],
                names=["key", "dimension", "x"],
            )

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, dimension int, x binary")


def added(parts: DataFrame, size: int) -> dict[int, np.ndarray]:
    """Sums of the arrays of (line, task, body) by line; one array of `size` a line comes to the driver."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["task"].to_pylist(), table["body"].to_pylist(), strict=True))
        total = np.zeros(size)
        for _, body in rows:
            total += np.frombuffer(body, "<f8")
        first = table.slice(0, 1)
        return pa.table({"line": first["line"], "task": [rows[0][0] // TOGETHER], "body": [total.tobytes()]})

    kind = "line int, task long, body binary"
    some = parts.groupBy("line", F.floor(F.col("task") / TOGETHER).alias("group")).applyInArrow(run, kind)
    return {r["line"]: np.frombuffer(r["body"], "<f8") for r in some.groupBy("line").applyInArrow(run, kind).collect()}


def matrix(fit: DataFrame, width: int, rows_of) -> np.ndarray:
    """The sum of yᵀy over batches of rows y = rows_of(column), `width` wide."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            y = rows_of(batch.column("x"))
            total += y.T @ y
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(width), pa.int32()),
                pa.array(np.full(width, task), pa.int64()),
                pa.array([line.tobytes() for line in total], pa.binary()),
            ],
            names=["line", "task", "body"],
        )

    lines = added(fit.mapInArrow(run, "line int, task long, body binary"), width)
    return np.array([lines[i] for i in range(width)])


def sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sums by dimension)."""

    def run(batches):
        n, high, low = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for batch in batches:
            x = decoded(batch.column("x"), dimension)
            n += len(x)
            high += (x >> LOW).sum(0)
            low += (x & ((1 << LOW) - 1)).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimension), pa.int32()), pa.array(np.full(dimension, n)), pa.array(high), pa.array(low)],
            names=["line", "n", "high", "low"],
        )

    made = fit.mapInArrow(run, "line int, n long, high long, low long").groupBy("line")
    lines = {r["line"]: r for r in made.agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))).collect()}
    total = [(lines[i]["high"] << LOW) + lines[i]["low"] for i in range(dimension)]
    return lines[0]["n"], total


class Factors:
    """LDLᵀ of a symmetric matrix, with symmetric pivoting by one or two rows."""

    ALPHA = (1 + 17**0.5) / 8

    def __init__(self, a: np.ndarray, least: float):
        a = a.copy()
        n = len(a)
        self.order, self.blocks, self.lower = np.arange(n), [], a
        self.positive = k = 0
        while k < n:
            below = np.abs(a[k + 1 :, k])
            r = k + 1 + int(below.argmax()) if len(below) else k
            most = below[r - k - 1] if len(below) else 0.0
            two = False
            if abs(a[k, k]) < self.ALPHA * most:
                line = np.abs(a[r, k:])
                line[r - k] = 0
                other = line.max()
                if abs(a[k, k]) * other < self.ALPHA * most * most:
                    two = abs(a[r, r]) < self.ALPHA * other
                    self._swap(k + two, r)
            if two:
                block = a[k : k + 2, k : k + 2].copy()
                side = a[k + 2 :, k : k + 2].copy()
                left = side @ np.linalg.inv(block)
                a[k + 2 :, k + 2 :] -= left @ side.T
                a[k + 2 :, k : k + 2] = left
                # Such a block has one eigenvalue of either sign.
                self.positive += 1
                self.blocks.append((k, block))
                k += 2
            else:
                if abs(a[k, k]) < least:
                    a[k, k] = least
                pivot = a[k, k]
                left = a[k + 1 :, k] / pivot
                a[k + 1 :, k + 1 :] -= np.outer(left, a[k + 1 :, k])
                a[k + 1 :, k] = left
                self.positive += int(pivot > 0)
                self.blocks.append((k, pivot))
                k += 1

    def _swap(self, i: int, j: int) -> None:
        if i != j:
            for x in (self.lower, self.lower.T, self.order):
                x[[i, j]] = x[[j, i]]

    def solve(self, b: np.ndarray) -> np.ndarray:
        a, y = self.lower, b[self.order].copy()
        for k, block in self.blocks:
            if np.ndim(block):
                y[k + 2 :] -= a[k + 2 :, k : k + 2] @ y[k : k + 2]
            else:
                y[k + 1 :] -= a[k + 1 :, k] * y[k]
        for k, block in reversed(self.blocks):
            if np.ndim(block):
                y[k : k + 2] = np.linalg.solve(block, y[k : k + 2]) - a[k + 2 :, k : k + 2].T @ y[k + 2 :]
            else:
                y[k] = y[k] / block - a[k + 1 :, k] @ y[k + 1 :]
        out = np.empty_like(y)
        out[self.order] = y
        return out


class Slices:
    """Eigenvalue counts of a symmetric matrix, and its leading eigenpairs."""

    def __init__(self, v: np.ndarray):
        self.v, self.n = (v + v.T) / 2, len(v)
        self.norm = float(np.abs(self.v).sum(1).max())
        #: (shift, eigenvalues above it), of all shifts tried.
        self.known = [(-self.norm - 1, self.n), (self.norm * (1 + 1e-9) + np.finfo(float).tiny, 0)]
        self.values: list[float] = []
        self.vectors: list[np.ndarray] = []
        self.random = np.random.default_rng(1)

    def factored(self, shift: float) -> Factors:
        found = Factors(self.v - shift * np.eye(self.n), EPS * self.norm / 16)
        self.known.append((shift, found.positive))
        return found

    def interval(self, k: int) -> tuple[float, float, int, int]:
        """(low, high, count above low, count above high) around eigenvalue number k."""
        low = max((s, c) for s, c in self.known if c >= k)
        high = min((s, c) for s, c in self.known if c < k and s > low[0])
        return low[0], high[0], low[1], high[1]

    def clear(self, x: np.ndarray) -> np.ndarray:
        """`x` of length 1, orthogonal to the vectors found."""
        for _ in range(2):
            for u in self.vectors:
                x = x - (u @ x) * u
            x = x / np.linalg.norm(x)
        return x

    def next(self) -> tuple[float, np.ndarray]:
        """The next eigenpair by falling eigenvalue."""
        k = len(self.values) + 1
        tight = 16 * EPS * self.norm
        while True:
            low, high, above_low, above_high = self.interval(k)
            if above_low - above_high == 1 or high - low <= tight:
                break
            self.factored((low + high) / 2)
        shift, x = (low + high) / 2, self.clear(self.random.standard_normal(self.n))
        best = (np.inf, shift, x)
        for _ in range(200):
            x = self.clear(self.factored(shift).solve(x))
            image = self.v @ x
            value = float(x @ image)
            off = float(np.linalg.norm(image - value * x))
            low, high, *_ = self.interval(k)
            inside = low - tight <= value <= high + tight
            if inside and off < best[0]:
                better, best = off < best[0] / 2, (off, value, x)
                # Rounding's floor: no step makes it better.
                if off <= 4 * EPS * self.norm or not better:
                    break
            elif inside and best[0] <= 64 * EPS * self.norm:
                break
            # A quotient outside the interval belongs to another eigenvalue: halve instead.
            shift = value if low < value < high else (low + high) / 2
        return best[1], best[2]

    def certified(self, k: int, value: float) -> bool:
        """Whether eigenvalue number k lies at `value`, but for rounding, by counts on both sides."""
        near = 256 * EPS * self.norm
        return self.factored(value - near).positive >= k > self.factored(value + near).positive

    def leading(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(eigenvalues, unit eigenvectors as columns), largest first; none that is rounding only."""
        while len(self.values) < min(number, self.n) and self.norm > 0:
            for _ in range(3):
                value, x = self.next()
                if done := self.certified(len(self.values) + 1, value):
                    break
            if not done:
                raise ArithmeticError(f"eigenvalue {len(self.values) + 1} is not certified by the counts")
            if value <= 64 * self.n * EPS * self.norm:
                break
            self.values.append(value)
            self.vectors.append(x)
        order = np.argsort(-np.array(self.values), kind="stable")
        if not len(order):
            return np.zeros(0), np.zeros((self.n, 0))
        return np.array(self.values)[order], np.array(self.vectors)[order].T


@dataclass(frozen=True)
class Whitening:
    """What whitening needs: exact number and sums of the fit list, eigenpairs, and checks."""

    dimension: int
    n: int
    totals: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.totals)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2; exact, NULL beyond 64 bits."""
        y = self.centred(x)
        about = float(self.n) ** 2 * (y * y).sum(1)
        # Wrapped at 64 bits, the arithmetic is exact wherever the result fits.
        wrapped = np.array([s % (1 << 64) for s in self.totals], np.uint64)
        z = np.uint64(self.n % (1 << 64)) * x.astype(np.uint64) - wrapped
        out: list[int | None] = (z * z).sum(1, dtype=np.uint64).astype(np.int64).tolist()
        for k in np.flatnonzero(about > 9e18).tolist():
            exact = sum((self.n * c - s) ** 2 for c, s in zip(x[k].tolist(), self.totals, strict=True))
            out[k] = exact if exact < 1 << 63 else None
        return out


def centred(x: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """x - S/n: whole numbers first, which is exact, then the fraction."""
    whole = np.array([s // n for s in totals], np.int64)
    return (x - whole).astype(np.float64) - np.array([s % n / n for s in totals])


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of `usable` rows; None without any."""
    commonest = rows.groupBy("dimension").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dimension")).first()
    if commonest is None:
        return None
    dimension = commonest["dimension"]
    if not dimension:
        return None
    distinct = stored(rows.where(F.col("dimension") == dimension).select("x").distinct())
    n, totals = sums(distinct, dimension)
    v = matrix(distinct, dimension, lambda c: centred(decoded(c, dimension), n, totals)) / n
    values, vectors = Slices(v).leading(components)
    explained = values / np.trace(v) if len(values) else values
    model = Whitening(dimension, n, totals, values, vectors, explained, 0.0)
    if not len(values):
        return model
    covariance = matrix(distinct, len(values), lambda c: model.project(decoded(c, dimension))) / n
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return Whitening(dimension, n, totals, values, vectors, explained, error)


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """(key, deviation, whitened) of `usable` rows of the model's dimension; whitened: a value a component."""
    mine = rows.where(F.col("dimension") == model.dimension).select("key", "x")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = decoded(batch.column("x"), model.dimension)
            w = model.project(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(model.deviation(x), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel())),
                ],
                names=["key", "deviation", "whitened"],
            )

    kind = mine.schema["key"].dataType.simpleString()
    return mine.mapInArrow(run, f"key {kind}, deviation long, whitened array<double>")


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def op13_embedding_whitening(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    spark = ready(table.sparkSession)
    rows = stored(usable(table))
    model = fit(rows, components)
    if model is None:
        kind = table.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, {RESULT}")
    share = F.array(*(F.lit(float(e)) for e in model.explained)) if len(model.explained) else F.lit(None).cast("array<double>")
    return whitened(rows, model).select(
        F.col("key").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share[F.col("at")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
