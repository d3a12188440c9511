"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

1. Every entry c becomes the integer x = floor(scale * c) + shift. Tasks sum
   x and the products of x as unbounded integers, Spark adds their limbs as
   longs, and the scatter n * sum(x x') - S S' is an exact integer matrix
   whatever the number of rows.
2. The scatter over n * n is the covariance V. Pivoted Cholesky gives
   P' V P = L L' with the largest remaining variance first, in extended
   precision, and stops at the numerical rank.
3. One-sided Jacobi rotates the columns of L until they are orthogonal:
   L W = U diag(s). Their squared norms are the eigenvalues of V and the
   normalised columns (rows put back by P) its components. V's entries are
   never squared again, so small eigenvalues keep their digits.

Only sums of d * d numbers reach the driver, whatever the number of rows.
"""

from __future__ import annotations

from decimal import Context, Decimal
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import bounded_batches, others, schema_of

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Jacobi ends when no two columns have a cosine above this
ORTHOGONAL = 1e-16
MAX_SWEEPS = 60
#: a remaining variance below this share of the largest is rounding
RANK_SHARE = 1e-17
_DIGITS = Context(prec=40)
#: vectors whose products a task sums at once
ROWS = 4096
#: bits of a limb of a task's sum; Spark adds up to 2**23 tasks' limbs in a long
LIMB = 40


def usable(df: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is neither null nor holds a null or non-finite entry."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.where(F.col(vector_col).isNotNull() & whole)


def _exact(values: np.ndarray, scale: int, shift: int) -> np.ndarray | None:
    """x as 64-bit integers, or None where they do not fit."""
    scaled = np.floor(values * scale)
    if scaled.size and np.abs(scaled).max() >= float(1 << 62):
        return None
    return scaled.astype(np.int64) + shift


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """Vectors of a batch, grouped in arrays of equal width (row index, values)."""
    column = column.cast(pa.large_list(pa.float64()))
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.asarray(column.values)
    width = np.diff(offs)
    out = []
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        out.append((at, flat[offs[at][:, None] + np.arange(w)]))
    return out


def _python_ints(values: np.ndarray, scale: int, shift: int) -> np.ndarray:
    """x as unbounded integers (an object array)."""
    whole = lambda c: int(c) * scale if abs(c) >= 2**53 else floor(c * scale)
    return np.array([[whole(c) + shift for c in row] for row in values.tolist()], object).reshape(values.shape)


def _products(part: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of y = floor(scale * c) and of its products, as unbounded integers."""
    y = np.floor(part * scale)
    top = float(np.abs(y).max()) if y.size else 0.0
    if top * top * len(y) < 2.0**53:  # every partial sum is an exact double
        return y.sum(axis=0).astype(np.int64).astype(object), (y.T @ y).astype(np.int64).astype(object)
    y = _python_ints(part, scale, 0)
    return y.sum(axis=0), y.T.dot(y)


def _limbs(total: int):
    """(place, limb) of an integer, least first; the sign is in every limb."""
    sign, rest, place = (-1 if total < 0 else 1), abs(total), 0
    while rest:
        yield place, sign * (rest & ((1 << LIMB) - 1))
        rest, place = rest >> LIMB, place + 1


def moments(df: DataFrame, vector_col: str, scale: int = SCALE, shift: int = SHIFT) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """width -> (n, S, Q): rows, sums of x, and sums of products of x, as
    unbounded integers. ``df``: rows of ``usable``. A few rows per width and
    pair of dimensions reach the driver."""
    bounded_batches(df.sparkSession)

    def task(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for at, values in _vectors(batch.column(0)):
                width = values.shape[1]
                own = sums.setdefault(width, [0, np.zeros(width, object), np.zeros((width, width), object)])
                for k in range(0, len(at), ROWS):
                    s, q = _products(values[k:k + ROWS], scale)
                    own[0] += len(values[k:k + ROWS])
                    own[1] += s
                    own[2] += q
        rows = []
        for w, (n, s, q) in sums.items():
            totals = [(-1, -1, n), *((i, -1, s[i]) for i in range(w)), *((i, j, q[i, j]) for i in range(w) for j in range(i, w))]
            rows += [(w, i, j, k, v) for i, j, total in totals for k, v in _limbs(int(total))]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (*(pa.int32(),) * 4, pa.int64()))], names=["width", "i", "j", "limb", "v"])

    added = (df.select(F.col(vector_col).cast("array<double>")).mapInArrow(task, "width int, i int, j int, limb int, v long")
             .groupBy("width", "i", "j", "limb").agg(F.sum("v").alias("v")).toArrow())
    found: dict[tuple[int, int, int], int] = {}
    for w, i, j, k, v in zip(*(c.to_pylist() for c in added.columns)):
        found[w, i, j] = found.get((w, i, j), 0) + (v << LIMB * k)
    out = {}
    for w in sorted({k[0] for k in found}):
        n = found[w, -1, -1]
        s = np.array([found.get((w, i, -1), 0) for i in range(w)], object)
        q = np.empty((w, w), object)
        for i in range(w):
            for j in range(i, w):
                q[i, j] = q[j, i] = found.get((w, i, j), 0) + shift * (s[i] + s[j]) + n * shift * shift
        out[w] = (n, s + n * shift, q)
    return out


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): v[order][:, order] = L L', L lower trapezoidal with as many
    columns as the numerical rank, in extended precision."""
    a = np.array(v, np.longdouble)
    d = len(a)
    order, l = np.arange(d), np.zeros((d, d), np.longdouble)
    top = a.diagonal().max() if d else 0.0
    for k in range(d):
        p = k + int(a.diagonal()[k:].argmax())
        if not a[p, p] > top * RANK_SHARE:
            return l[:, :k], order
        if p != k:
            for m in (a, a.T, l, order):
                m[[k, p]] = m[[p, k]]
        l[k, k] = np.sqrt(a[k, k])
        l[k + 1:, k] = a[k + 1:, k] / l[k, k]
        a[k + 1:, k + 1:] -= np.outer(l[k + 1:, k], l[k + 1:, k])
    return l, order


def jacobi(l: np.ndarray) -> np.ndarray:
    """The columns of ``l`` rotated until they are orthogonal (one-sided). A
    sweep meets every pair of columns once, in rounds of disjoint pairs."""
    g = np.array(l, np.longdouble).T.copy()
    r = len(g)
    seats = list(range(r + r % 2))  # an odd one out plays against nobody
    for _ in range(MAX_SWEEPS):
        moved = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(min(p), max(p)) for p in zip(seats[:half], seats[:half - 1:-1]) if max(p) < r]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            i, j = np.array(pairs).T
            x, y = g[i], g[j]
            a, b, c = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            turn = np.flatnonzero(np.abs(c) > ORTHOGONAL * np.sqrt(a * b))
            if not len(turn):
                continue
            moved = True
            a, b, c, x, y = a[turn], b[turn], c[turn], x[turn], y[turn]
            zeta = (b - a) / (2 * c)
            t = np.where(zeta >= 0, 1, -1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cos = (1 / np.sqrt(1 + t * t))[:, None]
            g[i[turn]], g[j[turn]] = cos * (x - t[:, None] * y), cos * (y + t[:, None] * x)
        if not moved:
            break
    return g.T


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance, falling, and its unit eigenvectors (rows)."""
    l, order = pivoted_cholesky(v)
    g = jacobi(l)
    norms = np.sqrt((g * g).sum(axis=0))
    keep = np.argsort(-norms, kind="stable")
    vectors = np.zeros((len(v), len(keep)), np.longdouble)
    vectors[order] = g[:, keep] / norms[keep]
    return norms[keep] ** 2, vectors.T


class Whitening:
    """A fitted width: n, S (integers), eigenvalues, components (rows), trace,
    and the largest deviation of the whitened covariance from the identity."""

    def __init__(self, n: int, s: np.ndarray, q: np.ndarray, most: int = COMPONENTS):
        self.n, self.s = n, s
        self.scatter = n * q - np.outer(s, s)  # n * n * V, exact
        exact = np.array([[_ratio(c, n * n) for c in row] for row in self.scatter], np.longdouble).reshape(len(s), len(s))
        self.trace = _ratio(sum(self.scatter.diagonal().tolist()), n * n)
        values, vectors = components(exact)
        self.values, self.vectors = values[:most], vectors[:most]
        # the covariance of the projections as they are made, over the exact V
        root = np.sqrt(self.values)
        made = np.asarray(self.vectors, np.float64).astype(np.longdouble)
        own = made @ exact @ made.T / np.outer(root, root) if len(root) else np.zeros((0, 0))
        self.identity_error = float(np.abs(own - np.eye(len(root))).max()) if len(root) else 0.0


def _ratio(a: int, b: int) -> np.longdouble:
    """a / b in extended precision."""
    return np.longdouble(str(_DIGITS.divide(Decimal(int(a)), Decimal(int(b)))))


def whiten(df: DataFrame, vector_col: str = "embedding", most: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """The other columns of each usable row with ``width``, ``n``,
    ``deviation`` (sum over dimensions of (n*x - S)^2, exact, as a decimal
    string), ``whitened`` (array of the first ``most`` components), and
    ``explained`` (array), ``identity_error`` of its fit.

    Every width (length of vector) is fitted by itself, over all its rows. Rows
    whose vector is null or holds a null or non-finite entry are left out;
    repeated rows count each. Components of no variance (beyond the rank, one
    row, equal rows) do not exist: the arrays are shorter, for width 0 empty.
    Ties of eigenvalues go by the order the rotations leave. Very wide vectors
    need d * d sums on the driver (2048 dimensions: 2 million numbers). An
    empty table gives an empty table. Columns that bear an output's name are
    replaced; all others are kept."""
    rows = usable(df, vector_col)
    fits = {w: Whitening(n, s, q, most) for w, (n, s, q) in moments(rows, vector_col, scale, shift).items()}
    names = ["width", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = others(df, vector_col, *names)
    doubles = T.ArrayType(T.DoubleType(), False)
    out = schema_of(df.select(*kept), T.StructField("width", T.IntegerType(), False), T.StructField("n", T.LongType(), False),
                    T.StructField("deviation", T.StringType(), False), T.StructField("whitened", doubles, False),
                    T.StructField("explained", doubles, False), T.StructField("identity_error", T.DoubleType(), False))
    #: what a task needs of each fit: numbers of the order of d
    small = {w: (f.n, [int(c) for c in f.s], np.asarray(f.vectors / np.sqrt(f.values)[:, None], np.longdouble),
                 [float(e / f.trace) for e in f.values], f.identity_error) for w, f in fits.items()}
    shared = df.sparkSession.sparkContext.broadcast(small)

    def task(batches):
        for batch in batches:
            count = batch.num_rows
            width, n, error = np.zeros(count, np.int32), np.zeros(count, np.int64), np.zeros(count)
            deviation, white, share = [None] * count, [None] * count, [None] * count
            for at, values in _vectors(batch.column(batch.num_columns - 1)):
                w = values.shape[1]
                total, s, turn, explained, wrong = shared.value[w]
                width[at], n[at], error[at] = w, total, wrong
                for k in range(0, len(at), ROWS):
                    part, own = values[k:k + ROWS], at[k:k + ROWS]
                    deviations, centred = _centred(part, total, s, scale, shift)
                    projected = np.asarray(centred @ turn.T, np.float64)
                    for r, d, p in zip(own.tolist(), deviations, projected.tolist()):
                        deviation[r], white[r], share[r] = str(d), p, explained
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(width), pa.array(n), pa.array(deviation, pa.string()),
                 pa.array(white, pa.list_(pa.float64())), pa.array(share, pa.list_(pa.float64())), pa.array(error)], names=out.names)

    cols = [F.col(c).alias(f"c{k}") for k, c in enumerate(kept)]
    return rows.select(*cols, F.col(vector_col).cast("array<double>").alias("_v")).mapInArrow(task, out)


#: (n*x - S) is cut into two parts of this many bits; sums of 64 products of
#: such parts fit 64 bits
_HALF = 28
_TERMS = 64


def _centred(values: np.ndarray, n: int, s: list[int], scale: int, shift: int) -> tuple[list[int], np.ndarray]:
    """Sum of (n*x - S)^2 of each vector, exact, and x - S/n (extended precision)."""
    x = _exact(values, scale, shift)
    bound = 0 if x is None or not x.size else n * int(np.abs(x).max()) + max(map(abs, s), default=0)
    if x is None or bound >= 1 << (2 * _HALF):
        big = (_python_ints(values, scale, shift) if x is None else x.astype(object)) * n - np.array(s, object)
        total = [int(t) for t in (big * big).sum(axis=1)]
        exact = (np.floor(values.astype(np.longdouble) * scale) + shift) if x is None else x.astype(np.longdouble)
    else:
        d = x * n - np.array(s, np.int64)
        low, high = d & ((1 << _HALF) - 1), d >> _HALF
        total = [0] * len(values)
        for k in range(0, x.shape[1], _TERMS):
            a, b = low[:, k:k + _TERMS], high[:, k:k + _TERMS]
            sums = ((a * a).sum(axis=1).tolist(), (a * b).sum(axis=1).tolist(), (b * b).sum(axis=1).tolist())
            total = [t + p + (q << (_HALF + 1)) + (r << 2 * _HALF) for t, p, q, r in zip(total, *sums)]
        exact = x.astype(np.longdouble)
    return total, exact - np.array([_ratio(c, n) for c in s], np.longdouble)
