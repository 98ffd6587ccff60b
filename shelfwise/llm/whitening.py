"""Whitening of vectors by a blockwise QR, Householder bidiagonalisation and the qd algorithm.

Components become whole numbers, so sums and means are exact. Tasks reduce their centred rows block
by block to one triangle; triangles are stacked and reduced again, a bounded number at a time, until one is left. Its
size depends on the dimensions only. Householder reflections bring it to bidiagonal form, whose squares
the dqds transforms turn into squared singular values with high relative accuracy, without ever
forming the covariance. Twisted factorisations of the bidiagonal's square, shifted by each of
them, give the directions; those of values that lie close together are made orthogonal.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize

SCALE, SHIFT = 1024, 100_000
#: Rows of a block of the QR, and triangles reduced at a time.
ROWS = 4_096
FAN_IN = 64
EPS = np.finfo(float).eps
#: Squared singular values this close, relative to the larger, share a cluster.
CLOSE = 1e-3


# ---- one triangle: singular values and directions


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, reflectors): ``a`` is U B V' with V the product of the right reflections."""
    a = a.copy()
    n = a.shape[1]
    right = np.zeros((n, n))

    def reflector(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x)
        v = x.copy()
        if norm == 0:
            return v
        v[0] += np.copysign(norm, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            w = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            right[k, k + 1:] = w
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One shifted quotient-difference transform; the least of the remainders, negative if the shift was too large."""
    new_q, new_e, d = [], [], q[0] - shift
    least = d
    for k in range(len(e)):
        new = d + e[k]
        if new <= 0:
            return new_q, new_e, -1.0
        t = q[k + 1] / new
        new_q.append(new)
        new_e.append(e[k] * t)
        d = d * t - shift
        least = min(least, d)
    new_q.append(d)
    return new_q, new_e, least


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values of a bidiagonal matrix, falling, by dqds with splitting and deflation."""
    top = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if top == 0:
        return np.zeros(len(diagonal))
    out: list[float] = []
    blocks = [([float(x) for x in (diagonal / top) ** 2], [float(x) for x in (above / top) ** 2], 0.0)]
    tiny = (EPS / 8) ** 2
    while blocks:
        q, e, moved = blocks.pop()
        least, tries = min(q), 0
        while True:
            if len(q) == 1:
                out.append(moved + q[0])
                break
            cut = next((k for k in reversed(range(len(e))) if e[k] <= tiny * (moved + min(q[k], q[k + 1])) or e[k] < 1e-300), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                least = min(q)
                continue
            # The lower value of the last two by two; when the transform refuses it, smaller ones, at last none.
            a, b, c = q[-2], e[-1], q[-1]
            half = (a + b + c) / 2
            corner = a * c / (half + np.sqrt(max(half * half - a * c, 0.0))) if half else 0.0
            shift = min(corner, least) * (1 - 1e-3 if tries == 0 else 0.5 ** tries) if tries < 4 else 0.0
            new_q, new_e, new_least = _dqds(q, e, shift)
            if new_least < 0 and shift > 0:
                tries += 1
                continue
            q, e, least, tries = new_q, new_e, max(new_least, 0.0), 0
            q[-1] = max(q[-1], 0.0)
            moved += shift
    return np.sort(np.array(out))[::-1] * top * top


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float, rank: int) -> np.ndarray:
    """A vector of B'B for ``value`` from the twisted factorisation with the ``rank``-th smallest twist."""
    n = len(diagonal)
    square, side, cross = diagonal**2, above**2, diagonal[:-1] * above
    least = EPS * EPS * max(square.max(), value) or 1e-300
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        pivot = square[i] + s[i]
        pivot = pivot if abs(pivot) > least else least
        lower[i] = cross[i] / pivot
        s[i + 1] = side[i] * s[i] / pivot - value
    p[-1] = square[-1] - value
    for i in reversed(range(n - 1)):
        pivot = side[i] + p[i + 1]
        pivot = pivot if abs(pivot) > least else least
        upper[i] = cross[i] / pivot
        p[i] = (p[i + 1] / pivot if side[i] else 1.0) * square[i] - value  # without a link the blocks are apart
    twist = int(np.argsort(np.abs(s + p + value), kind="stable")[rank])
    z = np.zeros(n)
    z[twist] = 1
    for i in reversed(range(twist)):
        z[i] = -lower[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """``count`` orthonormal columns for the first of ``values``; those of a cluster are taken one after the other."""
    top = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0), 1e-300)
    d, a, found = diagonal / top, above / top, np.zeros((len(diagonal), count))
    for j in range(count):
        value = values[j] / top / top
        near = [i for i in range(j) if values[i] - values[j] <= CLOSE * values[i]]
        for rank in range(len(d)):
            z = _twisted(d, a, value, rank)
            for _ in range(2):
                z = z - found[:, near] @ (found[:, near].T @ z)
            size = np.linalg.norm(z)
            if size > 0.1 or (rank == len(d) - 1 and size > 0):
                break
        found[:, j] = z / size
    return found


@dataclass
class Fit:
    """What whitening needs: rows, exact sums, directions as columns, their variances and the whole variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: the whole part exactly, then the rest."""
        whole = [s // self.n for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole)]
        return (x - np.array(whole, np.int64)).astype(np.float64) - np.array(rest)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum of squares of n x - sums of each row, as whole numbers of any size."""
        most = max([abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))] + [-(-abs(s) // self.n) for s in self.sums])
        if (2 * most * self.n) ** 2 * max(1, x.shape[1]) < 2**63:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(v) for v in (y * y).sum(axis=1)]


def solve(triangle: np.ndarray, n: int, sums: list[int], count: int) -> Fit:
    """The first ``count`` components of rows whose centred QR ends in ``triangle``; those without variance are left out."""
    diagonal, above, right = bidiagonal(triangle)
    values = squared_values(diagonal, above)
    have = int((values[:count] > values[:1] * (EPS * len(values)) ** 2).sum()) if len(values) and values[0] > 0 else 0
    axes = directions(diagonal, above, values, have)
    for k in reversed(range(len(diagonal))):
        axes = axes - 2 * np.outer(right[k], right[k] @ axes)
    return Fit(n, sums, axes, values[:have] / n, float(values.sum()) / n)


# ---- over all rows


def whole(batch_column: pa.Array, width: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows, x of each) for the vectors that take part; with ``width`` all x are one matrix."""
    sizes = np.diff(batch_column.offsets.to_numpy())
    flat = batch_column.values.slice(batch_column.offsets[0].as_py(), int(sizes.sum())).cast(pa.float64())
    number = flat.to_numpy(zero_copy_only=False)  # null becomes NaN
    with np.errstate(all="ignore"):
        scaled = np.floor(number * SCALE)
        good = np.abs(scaled) < 2.0**62  # not for NaN and infinity
    first = np.cumsum(sizes) - sizes
    bad = np.concatenate([[0], np.cumsum(~good)])
    valid = np.asarray(batch_column.is_valid()) & (sizes > 0) & (bad[first + sizes] == bad[first])
    if width is not None:
        valid &= sizes == width
    rows = np.flatnonzero(valid)
    x = np.where(good, scaled, 0).astype(np.int64) + SHIFT
    if width is not None:
        return rows, x[(first[rows, None] + np.arange(width)).ravel()].reshape(-1, width)
    return rows, [x[first[r]:first[r] + sizes[r]] for r in rows]


def _sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """(width, n, sums) of the vectors of the most common length, the longer of equally common ones."""

    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            rows, vectors_ = whole(batch.column(0))
            sizes = np.array([len(v) for v in vectors_], np.int64)
            for size in np.unique(sizes).tolist():
                x = np.stack([v for v in vectors_ if len(v) == size])
                entry = found.setdefault(size, [0, np.zeros(size, object)])
                entry[0] += len(x)
                # High and low halves, so that no sum of a batch can pass 64 bits.
                entry[1] += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        rows = [(size, i, n, int(s)) for size, (n, sums) in found.items() for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
            pa.array([r[3] >> 32 for r in rows], pa.int64()), pa.array([r[3] & 0xFFFFFFFF for r in rows], pa.int64())], ["size", "at", "n", "high", "low"])

    parts = vectors.mapInArrow(run, "size int, at int, n long, high long, low long")
    sums = parts.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38)")).alias("high"), F.sum(F.col("low").cast("decimal(38)")).alias("low"))
    sums = materialize(sums, "sums")
    best = sums.filter("at = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return 0, 0, []
    rows = sums.filter(F.col("size") == best["size"]).orderBy("at").collect()  # one row for each dimension
    return best["size"], best["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _triangle(vectors: DataFrame, width: int, centre: Fit) -> np.ndarray:
    def stacked(blocks: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.concatenate(blocks), mode="r")

    def batch_of(r: np.ndarray, part: int) -> pa.RecordBatch:
        square = np.zeros((width, width))
        square[:len(r)] = r
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([square.ravel().tolist()], pa.list_(pa.float64()))], ["part", "r"])

    def run(batches):
        import uuid

        r, part = np.zeros((0, width)), uuid.uuid4().int >> 66
        for batch in batches:
            _, x = whole(batch.column(0), width)
            for s in range(0, len(x), ROWS):
                r = stacked([r, centre.centred(x[s:s + ROWS])])
        if len(r):
            yield batch_of(r, part)

    def reduce(table: pa.Table) -> pa.Table:
        blocks = [np.array(r).reshape(width, width) for r in table["r"].to_pylist()]
        return pa.Table.from_batches([batch_of(stacked(blocks), table["part"][0].as_py())])

    parts = materialize(vectors.mapInArrow(run, "part long, r array<double>"), "triangles")
    while (n := parts.count()) > 1:
        dealt = parts.groupBy(F.pmod(F.xxhash64("part"), F.lit(-(-n // FAN_IN))))
        parts = materialize(dealt.applyInArrow(reduce, parts.schema), "triangles")
    return np.array(parts.first()["r"]).reshape(width, width)


def _moments(vectors: DataFrame, width: int, fit: Fit) -> float:
    """The largest entry of the whitened covariance less the identity, from centred moments that are merged."""
    k = fit.axes.shape[1]

    def merged(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        gap = b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def batch_of(state: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([state[0]], pa.int64()), pa.array([state[1].tolist()], pa.list_(pa.float64())),
                                           pa.array([state[2].ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "m"])

    def run(batches):
        state = None
        for batch in batches:
            _, x = whole(batch.column(0), width)
            for s in range(0, len(x), ROWS):
                w = fit.whitened(x[s:s + ROWS])
                mean = w.mean(axis=0)
                own = len(w), mean, (w - mean).T @ (w - mean)
                state = merged(state, own) if state else own
        if state:
            yield batch_of(state)

    def reduce(table: pa.Table) -> pa.Table:
        state = None
        for n, mean, m in zip(*(table[c].to_pylist() for c in ("n", "mean", "m"))):
            own = n, np.array(mean), np.array(m).reshape(k, k)
            state = merged(state, own) if state else own
        return pa.Table.from_batches([batch_of(state)])

    parts = materialize(vectors.mapInArrow(run, "n long, mean array<double>, m array<double>"), "moments")
    while (n := parts.count()) > 1:
        dealt = parts.groupBy(F.pmod(F.xxhash64("mean"), F.lit(-(-n // FAN_IN))))
        parts = materialize(dealt.applyInArrow(reduce, parts.schema), "moments")
    last = parts.first()
    return float(np.abs(np.array(last["m"]).reshape(k, k) / last["n"] - np.eye(k)).max())


def fitted(vectors: DataFrame, count: int) -> tuple[int, Fit | None]:
    """(width, fit) of a frame with one column of vectors; no fit without a vector or without variance."""
    width, n, sums = _sums(vectors)
    if not n:
        return 0, None
    centre = Fit(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    fit = solve(_triangle(vectors, width, centre), n, sums, count)
    return width, fit if len(fit.variances) else None


def whiten(df: DataFrame, count: int = 8, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) of each vector that takes part, one row each.

    An entry c counts as x = floor(1024 c) + 100000. ``deviation`` is the exact sum of squares of n x - S, as a decimal, null over 38 digits;
    ``whitened`` and ``explained`` are lists over the components, at most ``count``, by falling variance.

    Left out: vectors that are null or empty, that hold a null, NaN, infinite entry or one without a 64-bit x, and those of
    another length than the most common one (of equally common lengths the longest). Rows repeat as they are; a null id is
    an id. Components without variance, as with equal or too few vectors, are left out; an empty table, or one without
    any variance, gives no rows. Other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"{id_col} {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    width, fit = fitted(rows.select("v"), count)
    if fit is None:
        return df.sparkSession.createDataFrame([], schema)
    error = _moments(rows.select("v"), width, fit)
    explained = (fit.variances / fit.total).tolist()

    def run(batches):
        for batch in batches:
            taken, x = whole(batch.column(1), width)
            if not len(taken):
                continue
            deviations = [d if d < 10**38 else None for d in fit.deviations(x)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(taken)), pa.array([fit.n] * len(taken), pa.int64()),
                pa.array(deviations, pa.decimal128(38, 0)), pa.array(fit.whitened(x).tolist(), pa.list_(pa.float64())),
                pa.array([explained] * len(taken), pa.list_(pa.float64())), pa.array([error] * len(taken), pa.float64())],
                [id_col, "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def by_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """A row for each component of ``whiten``'s rows; a deviation over 64 bits is null."""
    rows = whitened.select(id_col, "n", F.expr("try_cast(deviation as long)").alias("deviation"), "identity_error",
                           F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return rows.select(id_col, (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                       F.col("c.explained").alias("explained"), "identity_error")
