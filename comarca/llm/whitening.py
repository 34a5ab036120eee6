"""Whitening of vectors by a bidiagonal qd solver.

Each entry c of a vector counts as the whole number x = floor(64 c) + 1000000. Sums of x are
exact; rows are centred in whole numbers before anything is multiplied, so their offset
costs no digits. Then

1. each task reduces its centred rows to a triangle R by blockwise QR, triangles are
   merged in a second stage, and the driver gets at most ``MERGERS`` of them;
2. Householder reflections make R bidiagonal, from both sides;
3. the dqds algorithm finds the singular values of the bidiagonal matrix, small ones to the
   same number of digits as large ones;
4. each value's direction comes from the twisted factorisation of the shifted matrix. Of
   values closer than ``CLOSE`` only the space they span is well defined: there inverse
   iteration with all of them finds an orthonormal basis, and a small decomposition inside it.

A covariance is never formed. What the driver holds is some d x d matrices, whatever the rows.

Defined results: rows whose vector is NULL, empty, or has a NULL, NaN or infinite entry, or one
of 2^56 and more (its x is no long), are left out, as are vectors of another length than
most have (of equally many the shorter). Components of no variance have NULL ``whitened``;
``identity_error`` is over the others and NULL without any; ``explained`` is 0 where there is
no variance at all. A ``deviation`` beyond a long is NULL. Repeated rows count each; NULL ids
are allowed; an empty table gives no rows; other columns never matter.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.llm.frames import shipped
from comarca.sinks.pinned import pin

UNITS, OFFSET = 64, 1_000_000
COMPONENTS = 32
MERGERS = 16
# Rows that are reduced at a time.
BLOCK_ROWS = 2048
# Relative gap below which the directions of two values are found together.
CLOSE = 1e-3
LARGEST = float(1 << 56)
EPS = float(np.finfo(float).eps)
_HALF = 31


def fit_rows(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, c: array<double>, size) of the rows that count, whatever their length."""
    bad = F.exists("c", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    rows = vectors.select(vectors[f"`{vec_id}`"].alias("vec_id"), vectors[f"`{vector}`"].cast("array<double>").alias("c"))
    return rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & ~bad).withColumn("size", F.size("c"))


def whole_entries(column: pa.Array, size: int) -> np.ndarray:
    """x of each row of an Arrow column of lists of ``size`` numbers."""
    c = np.asarray(column.flatten()).reshape(-1, size)
    return np.floor(UNITS * c).astype(np.int64) + OFFSET


def exact_sums(rows: DataFrame) -> tuple[int, int, list[int]]:
    """The length that most rows have, their number and the sums of their entries."""

    def per_task(batches):
        held: dict[int, list] = {}
        for batch in batches:
            sizes = batch["size"].to_numpy()
            for size in np.unique(sizes).tolist():
                x = whole_entries(batch["c"].filter(pa.array(sizes == size)), size)
                sums = held.setdefault(size, [0, np.zeros(size, np.int64), np.zeros(size, np.int64)])
                sums[0] += len(x)
                # In halves, which can't overflow in one task.
                sums[1] += (x >> _HALF).sum(axis=0)
                sums[2] += (x & ((1 << _HALF) - 1)).sum(axis=0)
        for size, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int32()), pa.array([n], pa.int64()), *(pa.array([v.tolist()]) for v in (high, low))],
                names=["size", "n", "high", "low"],
            )

    parts = pin(rows.mapInArrow(per_task, "size int, n long, high array<long>, low array<long>"), "vector-sums")
    most = parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "size").first()
    if most is None:
        return 0, 0, []
    halves = F.posexplode(F.arrays_zip("high", "low")).alias("at", "half")
    sums = parts.where(F.col("size") == most["size"]).select(halves).groupBy("at").agg(
        *[F.sum(F.col(f"half.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    )
    return most["size"], most["n"], [(int(r["high"]) << _HALF) + int(r["low"]) for r in sums.orderBy("at").collect()]


@dataclass(frozen=True)
class Centre:
    """n and the sums of the fit list: rows less their mean, without a rounding before the last step."""

    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S in whole numbers; Python's where a long would not hold them."""
        largest = max([int(np.abs(x).max(initial=0)), 1]) * self.n + max(map(abs, self.sums))
        if largest < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def rows(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(float)

    def squares(self, deviations: np.ndarray) -> list[int | None]:
        """Their sums of squares, exact; None beyond a long."""
        if deviations.dtype != object and len(self.sums) * float(np.abs(deviations).max(initial=0)) ** 2 < 2.0**62:
            return (deviations * deviations).sum(axis=1).tolist()
        return [s if (s := sum(int(v) * int(v) for v in row)) < 1 << 63 else None for row in deviations]


def triangle(rows: DataFrame, centre: Centre) -> np.ndarray:
    """R of the centred rows, d x d."""
    d = len(centre.sums)

    def stacked(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        held, waiting = np.zeros((0, d)), []
        for part in itertools.chain(parts, [None]):
            if part is not None:
                waiting.append(part)
            if waiting and (part is None or sum(map(len, waiting)) >= max(BLOCK_ROWS, d)):
                held, waiting = np.linalg.qr(np.concatenate([held, *waiting]), mode="r"), []
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([held.reshape(-1).tolist()])], names=["r"])

    def reduce(batches):
        return stacked(centre.rows(centre.deviations(whole_entries(b["c"], d))) for b in batches)

    def merge(batches):
        return stacked(np.asarray(r.values).reshape(-1, d) for b in batches for r in b["r"])

    parts = rows.select("c").mapInArrow(reduce, "r array<double>")
    found = parts.repartition(MERGERS, F.xxhash64("r")).mapInArrow(merge, "r array<double>").collect()
    last = [np.array(r["r"]).reshape(-1, d) for r in found]
    r = np.linalg.qr(np.concatenate([*last, np.zeros((d, d))]), mode="r")
    return r[:d]


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' r V, and V, by Householder reflections from both sides."""
    a, d = r.copy(), len(r)
    v = np.eye(d)

    def reflection(x: np.ndarray) -> tuple[np.ndarray, float]:
        """w and t so that (I - t w w') x has one entry that is not 0."""
        norm = np.linalg.norm(x)
        if norm == 0:
            return x, 0.0
        w = x / norm
        w[0] += np.copysign(1.0, w[0])
        return w, 2.0 / (w @ w)

    for k in range(d):
        w, t = reflection(a[k:, k].copy())
        a[k:, k:] -= t * np.outer(w, w @ a[k:, k:])
        if k < d - 1:
            w, t = reflection(a[k, k + 1 :].copy())
            a[k:, k + 1 :] -= t * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= t * np.outer(v[:, k + 1 :] @ w, w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential qd transform with a shift, and its d; None where the shift was above the least value."""
    d, new_q, new_e, all_d = q[0] - shift, [], [], []
    for i in range(len(q) - 1):
        all_d.append(d)
        one = d + e[i]
        if not one > 0 or d < 0:
            return None
        ratio = q[i + 1] / one
        new_q.append(one)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    all_d.append(d)
    if not d >= 0:
        return None
    return [*new_q, d], new_e, all_d


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix by dqds, falling.

    Each shift is 1 / trace of the inverse, which the transform without a shift gives
    and which no value is below; so shifts only ever add up.
    """
    found: list[float] = []
    work = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    least = EPS * EPS
    for _ in range(1000 * (len(diagonal) + 1)):
        if not work:
            return np.array(sorted(found, reverse=True))
        q, e, sigma = work.pop()
        if len(q) == 1 or e[-1] <= least * (sigma + q[-1]):
            found.append(q[-1] + sigma)
            if len(q) > 1:
                work.append((q[:-1], e[:-1], sigma))
            continue
        cut = next((i for i in range(len(e) - 1) if e[i] <= least * (sigma + min(q[i], q[i + 1]))), None)
        if cut is not None:
            work += [(q[: cut + 1], e[:cut], sigma), (q[cut + 1 :], e[cut + 1 :], sigma)]
            continue
        if q[0] < q[-1]:
            # Small values belong to the end, where they are split off; the values stay the same.
            q, e = q[::-1], e[::-1]
        q, e, d = qd_step(q, e, 0.0)
        if min(d) > 0:
            # Rounding may have put it a little too high; then a transform without a shift is enough.
            shift = (1 - 1e-10) / sum(1 / x for x in d)
            step = qd_step(q, e, shift)
            if step is not None:
                q, e, sigma = step[0], step[1], sigma + shift
        work.append((q, e, sigma))
    raise ArithmeticError("the qd transforms did not settle")


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B for an eigenvalue, B upper bidiagonal with no zero entry.

    The shifted matrix is factored from the top and from the bottom; both meet where
    the diagonal that is left is least, and the vector is read off from there.
    """
    n = len(diagonal)
    big = (diagonal**2).tolist()
    low = (above / diagonal[:-1]).tolist()
    tiny = EPS * value or EPS * EPS
    s, down = [-value], []
    for i in range(n - 1):
        one = big[i] + s[i] or tiny
        down.append(big[i] * low[i] / one)
        s.append(down[i] * low[i] * s[i] - value)
    p, up, gamma = big[-1] - value, [0.0] * (n - 1), [0.0] * n
    gamma[-1] = s[-1] + big[-1]
    for i in range(n - 2, -1, -1):
        one = big[i] * low[i] ** 2 + p or tiny
        ratio = big[i] / one
        up[i] = low[i] * ratio
        gamma[i] = s[i] + p * ratio
        p = p * ratio - value
    at = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -up[i] * z[i]
    with np.errstate(all="ignore"):
        z = z / np.abs(z).max()
        return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal right singular vectors of an unreduced bidiagonal matrix, a column for each squared value."""
    n = len(diagonal)
    z = np.column_stack([twisted(diagonal, above, v) for v in values])
    close = values[:-1] - values[1:] <= CLOSE * values[:-1]
    first = 0
    for end in [*(np.flatnonzero(~close) + 1).tolist(), n]:
        if end - first > 1 or not np.isfinite(z[:, first:end]).all():
            z[:, first:end] = close_vectors(diagonal, above, values[first:end], z[:, first:end])
        first = end
    return z


def close_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Directions of values that lie close: the space of all of them by inverse iteration, then its own directions."""
    n, k = start.shape

    def times(y):
        """B y."""
        found = diagonal[:, None] * y
        found[:-1] += above[:, None] * y[1:]
        return found

    def back(y):
        """B' y."""
        found = diagonal[:, None] * y
        found[1:] += above[:, None] * y[:-1]
        return found

    y = np.eye(n)
    if k < n:
        # A shift that is a value itself would have no inverse.
        shift = (values[0] + values[-1]) / 2 * (1 - 1e-6)
        size = np.sqrt(values[0]) * (np.abs(diagonal).max() + np.abs(above).max())
        y = np.where(np.isfinite(start), start, 0.0) + 1e-3 * np.random.default_rng(7).standard_normal((n, k))
        for _ in range(40):
            y = np.linalg.qr(shifted_solve(diagonal, above, shift, y))[0]
            product = times(y)
            if np.abs(back(product) - y @ (product.T @ product)).max() <= 2 * EPS * size:
                break
    return y @ np.linalg.svd(times(y), full_matrices=False)[2].T


def shifted_solve(diagonal: np.ndarray, above: np.ndarray, shift: float, y: np.ndarray) -> np.ndarray:
    """(B'B - shift)^-1 y through the factors of the shifted matrix, which come from those of B'B itself."""
    n = len(diagonal)
    big, low = diagonal**2, above / diagonal[:-1]
    s, pivots, down, x = -shift, np.zeros(n), np.zeros(n - 1), y.copy()
    for i in range(n - 1):
        pivots[i] = big[i] + s or EPS * shift
        down[i] = big[i] * low[i] / pivots[i]
        s = down[i] * low[i] * s - shift
        x[i + 1] -= down[i] * x[i]
    pivots[-1] = big[-1] + s or EPS * shift
    x /= pivots[:, None]
    for i in range(n - 2, -1, -1):
        x[i] -= down[i] * x[i + 1]
    # Columns may be of any size; only their directions matter.
    return x / np.abs(x).max(axis=0)


@dataclass(frozen=True)
class Whitening:
    """Columns of ``directions`` are unit eigenvectors of the covariance, ``variances`` their eigenvalues, falling."""

    centre: Centre
    directions: np.ndarray
    variances: np.ndarray

    def live(self) -> np.ndarray:
        """Components that have a variance beyond what rounding leaves."""
        floor = (len(self.variances) * EPS) ** 2 * self.variances.max(initial=0)
        return self.variances > floor

    def explained(self) -> np.ndarray:
        return self.variances / (self.variances.sum() or 1.0)

    def whitened(self, centred: np.ndarray, components: int) -> np.ndarray:
        """A column per component; NaN where it has no variance."""
        spread = np.where(self.live(), np.sqrt(self.variances), np.nan)[:components]
        return centred @ self.directions[:, :components] / spread


def principal(r: np.ndarray, centre: Centre) -> Whitening:
    """Directions and variances from the triangle of the centred rows."""
    d = len(r)
    scale = np.abs(r).max(initial=0)
    if scale == 0:
        return Whitening(centre, np.eye(d), np.zeros(d))
    diagonal, above, v = bidiagonal(r / scale)
    # No entry is taken for more exact than the reflections leave it.
    diagonal = np.where(np.abs(diagonal) < EPS * EPS, EPS * EPS, diagonal)
    beside = np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    above = np.where(np.abs(above) <= EPS * beside, 0.0, above)
    values, vectors = np.zeros(d), np.zeros((d, d))
    first = 0
    # Where the superdiagonal is 0 the matrix falls apart.
    for end in [*(np.flatnonzero(above == 0) + 1).tolist(), d]:
        here, there = slice(first, end), slice(first, end - 1)
        values[here] = squared_values(diagonal[here], above[there])
        vectors[here, here] = right_vectors(diagonal[here], above[there], values[here])
        first = end
    order = np.argsort(-values, kind="stable")
    directions = v @ vectors[:, order]
    # Either sign would do; the largest entry is positive.
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(d)])
    return Whitening(centre, directions * np.where(signs == 0, 1.0, signs), values[order] * scale * scale / centre.n)


def identity_error(rows: DataFrame, found: Whitening, components: int) -> float | None:
    """The largest absolute entry of the covariance of the whitened rows less the identity."""
    d = len(found.centre.sums)
    live = np.flatnonzero(found.live()[:components])
    if not len(live):
        return None
    k = len(live)
    shared = shipped(rows.sparkSession, found)

    def added(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for one, two in parts:
            sums, products = sums + one, products + two
        yield pa.RecordBatch.from_arrays(
            [pa.array([sums.tolist()]), pa.array([products.reshape(-1).tolist()])], names=["sums", "products"]
        )

    def measure(batches):
        model = shared()

        def parts():
            for batch in batches:
                centred = model.centre.rows(model.centre.deviations(whole_entries(batch["c"], d)))
                w = model.whitened(centred, components)[:, live]
                yield w.sum(axis=0), w.T @ w

        return added(parts())

    def merge(batches):
        return added(
            (np.asarray(s.values), np.asarray(p.values).reshape(k, k))
            for b in batches for s, p in zip(b["sums"], b["products"])
        )

    ddl = "sums array<double>, products array<double>"
    parts = rows.select("c").mapInArrow(measure, ddl)
    merged = parts.repartition(MERGERS, F.xxhash64("products")).mapInArrow(merge, ddl).collect()
    mean = sum(np.array(r["sums"]) for r in merged) / found.centre.n
    products = sum(np.array(r["products"]).reshape(k, k) for r in merged) / found.centre.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


def fit(rows: DataFrame) -> Whitening | None:
    """From what ``fit_rows`` gives; None without rows."""
    d, n, sums = exact_sums(rows)
    if not n:
        return None
    centre = Centre(n, sums)
    return principal(triangle(rows.where(F.col("size") == d), centre), centre)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    rows = fit_rows(vectors, vec_id, vector)
    schema = T.StructType([
        rows.schema["vec_id"], T.StructField("component", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in ("n", "deviation")],
        *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")],
    ])
    found = fit(rows)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    d = len(found.centre.sums)
    rows = rows.where(F.col("size") == d)
    error = identity_error(rows, found, components)
    shared, k = shipped(vectors.sparkSession, found), min(components, d)

    def per_batch(batches):
        model = shared()
        explained = model.explained()[:k]
        for batch in batches:
            # Some rows at a time: each becomes k.
            for first in range(0, len(batch), 1024):
                part = batch.slice(first, 1024)
                n = len(part)
                deviations = model.centre.deviations(whole_entries(part["c"], d))
                whitened = model.whitened(model.centre.rows(deviations), k).reshape(-1)
                squares = pa.array(model.centre.squares(deviations), pa.int64())
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays([
                    part["vec_id"].take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, model.centre.n)), squares.take(each),
                    pa.array(whitened, mask=np.isnan(whitened)), pa.array(np.tile(explained, n)),
                    pa.array([error] * (n * k), pa.float64()),
                ], names=schema.names)

    return rows.select("vec_id", "c").mapInArrow(per_batch, schema)
