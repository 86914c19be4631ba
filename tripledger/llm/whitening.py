"""Whitening of embeddings along their strongest components.

Entries become whole numbers, ``floor(SCALE * c)``; the *fit list* holds each distinct vector of them once. Its size, sums and centred
covariance are added up over Spark partitions (one matrix row per group, so no task gathers all matrices). The covariance, of the
size of the dimension squared whatever the number of rows, is then split on the driver by QDWH spectral divide and conquer:

* the polar factor U of ``A - shift`` is found by the QR-based dynamically weighted Halley iteration, six steps at most;
* ``(U + 1) / 2`` projects on the eigenvectors above the shift, and its range and complement are invariant subspaces;
* each one is split again, by the mean of its own eigenvalues, until it has one dimension, or all its eigenvalues are equal. Subspaces
  below the wanted components are not entered.

Components and centre, ``dimension x wanted`` numbers, go to all tasks with the function that projects each row.

Rows whose vector is null or holds a null, NaN or infinite entry give no rows. If vectors differ in length, the commonest length counts
(of equally common ones the greatest) and rows of other lengths give none; nor do empty vectors. Entries past 64 bits are held at the
ends of that range, and a ``deviation`` past 64 bits is null. Components without variance (eigenvalues lost in rounding) are left
out, so a table of equal vectors, or an empty one, gives no rows. Repeated rows give repeated rows; a null id stays null. Equal
eigenvalues leave their components free within their subspace. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import stored

SCALE = 256
WANTED = 4
EPS = np.finfo(float).eps
# Eigenvalues under this share of the greatest one hold rounding only.
NO_VARIANCE = 1e-12
LIMIT = 1 << 63


# Spectral divide and conquer ---------------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix: all its eigenvalues go to 1 or -1, by their sign.

    Each step is a weighted Halley step whose weights follow the least singular value ``low`` that is known so far.
    """
    size = len(a)
    x = a / np.linalg.norm(a)
    low = max(EPS, 1 / np.linalg.norm(np.linalg.inv(x))) if np.linalg.cond(x, 1) < 1 / EPS else EPS
    for _ in range(20):
        gap = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + gap)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * gap + 8 * (2 - low**2) / (low**2 * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        # X (a + b X'X) / (1 + c X'X), without the inverse of a badly conditioned matrix.
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(size)]))
        step = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        step = (step + step.T) / 2
        moved = np.linalg.norm(step - x)
        x, low = step, min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(5 * EPS):
            break
    return x


def invariant_subspaces(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above the shift and of the others; None if the shift meets an eigenvalue."""
    projector = (polar_factor(a - shift * np.eye(len(a))) + np.eye(len(a))) / 2
    rank = int(round(np.trace(projector)))
    if not 0 < rank < len(a) or np.linalg.norm(projector @ projector - projector) > 1e-8:
        return None
    # Columns of a projector span its range; those of most weight, in turn, are a basis.
    rest, picked = projector.copy(), []
    for _ in range(rank):
        weights = (rest**2).sum(0)
        weights[picked] = -1
        picked.append(int(weights.argmax()))
        column = rest[:, picked[-1]] / np.sqrt(weights[picked[-1]])
        rest = rest - np.outer(column, column @ rest)
    start = np.hstack([projector[:, picked], np.eye(len(a)) - projector])
    first, _ = np.linalg.qr(start[:, :rank])
    # Once more through the projector: what the chosen columns lost to rounding comes back.
    first, _ = np.linalg.qr(projector @ first)
    both, _ = np.linalg.qr(np.hstack([first, np.eye(len(a))]), mode="complete")
    return first, both[:, rank:]


def leading_components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    scale = np.linalg.norm(a)
    values, vectors = [], []

    def split(part: np.ndarray, basis: np.ndarray) -> None:
        if len(values) >= wanted:
            return
        mean = np.trace(part) / len(part)
        spread = np.linalg.norm(part - mean * np.eye(len(part)))
        if len(part) == 1 or spread <= 4 * EPS * scale:
            for column in basis.T:
                values.append(float(column @ a @ column))
                vectors.append(column)
            return
        # The mean of eigenvalues lies between the least and the greatest; if one sits on it, a shift nearby parts them.
        for nudge in (0, 1, -1, 3, -3):
            found = invariant_subspaces(part, mean + nudge * spread / len(part) / 16)
            if found:
                break
        else:
            # Eigenvalues too near to each other to be told apart: their basis stays.
            values.extend(np.full(len(part), mean))
            vectors.extend(basis.T)
            return
        for own in found:
            inner = own.T @ part @ own
            split((inner + inner.T) / 2, basis @ own)

    if len(a) and scale > 0:
        split((a + a.T) / 2, np.eye(len(a)))
    values, vectors = np.array(values[:wanted]), np.array(vectors[:wanted]).reshape(-1, len(a)).T
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# Sums over Spark -----------------------------------------------------------------------------------


def whole_numbers(vector: Column) -> Column:
    """``floor(SCALE * c)`` of each entry as long; null if the vector is null or an entry is null or not finite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(fine, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(0).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of whole numbers; all lists are of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(parts: DataFrame, kind: type = float) -> dict[int, np.ndarray]:
    """Sums of the rows that tasks have under one number; what reaches the driver does not grow with the input."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = kind(0)
        for batch in batches:
            for values in batch.column("row").to_pylist():
                total = total + np.frombuffer(values, kind)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["number", "row"])

    rows = parts.groupBy("number").applyInArrow(add, "number int, row binary").collect()
    return {r["number"]: np.frombuffer(r["row"], kind) for r in rows}


def _per_task(df: DataFrame, size: int, rows_of) -> DataFrame:
    """number, row: ``rows_of`` (a matrix) of each batch, added up within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = rows_of(_matrix(batch.column("x")))
                total = found if total is None else total + found
        if total is not None:
            rows = pa.array([r.tobytes() for r in total], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), rows], names=["number", "row"])

    return df.mapInArrow(run, "number int, row binary")


@dataclass(frozen=True)
class Whitening:
    """What a table of vectors was fitted to: ``n`` distinct vectors, their sums, and components with eigenvalues."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``: whole numbers are taken off exactly, the rest of the mean as a fraction."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])
        if max(map(abs, whole), default=0) < 1 << 52 and (np.abs(x) < 1 << 52).all():
            return (x - np.array(whole, np.int64)) - rest
        return (x.astype(object) - np.array(whole, object)).astype(float) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of ``(n x - sums) ** 2`` of each row, exact; None beyond 64 bits."""
        most = max(map(abs, self.sums), default=0) + self.n * (int(np.abs(x).max()) if x.size and x.min() > -LIMIT else LIMIT)
        if len(self.sums) * most**2 < LIMIT:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(1)
        return [int(v) if v < LIMIT else None for v in exact]


def commonest_length(vectors: DataFrame) -> int:
    """Of the lengths of column ``x``, the commonest; the greater one of equally common ones; 0 if there is none."""
    sizes = vectors.where("size(x) > 0").groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return first["size"] if first else 0


def fitted(distinct: DataFrame, size: int, wanted: int = WANTED) -> Whitening | None:
    """Components of the distinct vectors in column ``x``, all of ``size`` entries; None if nothing varies."""

    def pieces(x: np.ndarray) -> np.ndarray:
        # Three pieces of 64 bits are added apart, so that no sum of up to 2^39 vectors leaves 64 bits.
        return np.array([(x >> 48).sum(0), (x >> 24 & 0xFFFFFF).sum(0), (x & 0xFFFFFF).sum(0), np.full(size, len(x))], np.int64)

    sums = _added(_per_task(distinct, size, pieces), np.int64)
    if not sums:
        return None
    n = int(sums[3][0])
    exact = tuple((int(a) << 48) + (int(b) << 24) + int(c) for a, b, c in zip(sums[0], sums[1], sums[2]))
    centre = Whitening(n, exact, np.zeros(0), np.zeros((size, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        return c.T @ c

    rows = _added(_per_task(distinct, size, products))
    covariance = np.array([rows[i] for i in range(size)]) / n
    trace = float(np.trace(covariance))
    values, vectors = leading_components(covariance, min(wanted, size))
    some = values > NO_VARIANCE * max(values, default=0)
    if not trace > 0 or not some.any():
        return None
    found = Whitening(n, exact, values[some], vectors[:, some], trace)

    def moments(x: np.ndarray) -> np.ndarray:
        w = found.whitened(x)
        return np.vstack([w.T @ w, w.sum(0)])

    rows = _added(_per_task(distinct, size, moments))
    count = len(found.values)
    mean = rows[count] / n
    second = np.array([rows[i] for i in range(count)]) / n - np.outer(mean, mean)
    return Whitening(n, exact, found.values, found.vectors, trace, float(np.abs(second - np.eye(count)).max()))


def whiten(df: DataFrame, wanted: int = WANTED, vector: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """One row per vector and component: see the module. ``identity_error`` is measured over the fit list, in a pass of its own."""
    kind = df.schema[row_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = df.select(F.col(f"`{row_id}`").alias("vec_id"), whole_numbers(F.col(f"`{vector}`")).alias("x")).where("x IS NOT NULL")
    # Distinct within the task first, then over all: a vector that a third of all rows hold is no hot key.
    distinct = stored(rows.select("x").distinct(), "fit-list")
    size = commonest_length(rows)
    alike = distinct.where(F.size("x") == size)
    fit = fitted(alike, size, wanted) if size else None
    if fit is None:
        return df.sparkSession.createDataFrame([], schema)
    count = len(fit.values)
    explained = fit.values / fit.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            each = np.repeat(np.arange(len(x)), count)
            total = len(each)
            columns = [
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(total, fit.n, np.int64)),
                pa.array(fit.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(fit.whitened(x).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(total, fit.identity_error)),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.where(F.size("x") == size).mapInArrow(run, schema)
