"""Operator 11, embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become integers, x = floor(64 c) + 1000000, so sums are exact.

1. One scan sums x for each dimension.  A second one adds up the products of x
   less its rounded mean, in integers: small numbers, exact in any order.  What
   rounding left of the mean is taken off exactly, so the covariance V is the
   centred scatter over n with a single rounding for each entry.
2. V = G G', G by Cholesky with the greatest remaining pivot; columns end where
   the remaining pivots are rounding errors (``pivoted_cholesky``).
3. One-sided Jacobi turns the columns of the triangular factor, pair by pair,
   until all are orthogonal (``jacobi``).  Their squared norms are the eigenvalues
   of V, the normalised columns its eigenvectors; V itself is not used again.
4. Rows are projected; a third scan adds up the covariance of the projections,
   centred in each task and merged by the formula for two samples.

Only sums travel: a task's are d x d numbers for vectors of d entries, whatever
its rows, and they are added up in two steps of tasks before one row of them
reaches the driver, where the factors are made.

Results for odd input: rows whose vector is null, empty, or holds a null or
non-finite entry, or one whose x is over 2^62, are dropped, as are vectors of
another length than most have (ties: the longer); a null id is left null;
repeated rows count each; extra columns are left alone; an empty table gives an
empty result.  A component without variance (fewer rows than dimensions, equal
rows) has explained 0 and a null ``whitened``, and is left out of
``identity_error``, which is null if no component has variance.  ``deviation`` is
null where it does not fit in a long.  Equal eigenvalues: in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import partitions, stored

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
_EXACT, _LONG = 1 << 53, 1 << 62


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector in the batch: the rows and their x (long)."""
    col = batch.column("v")
    flat = col.flatten()
    size = np.where(col.is_valid().to_numpy(zero_copy_only=False), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    ends = np.append(0, np.cumsum(size))
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    for d in np.unique(size[size > 0]).tolist():
        every, step = np.flatnonzero(size == d), max(1, (1 << 20) // d)
        for at in range(0, len(every), step):
            rows = every[at:at + step]
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(values[ends[rows][:, None] + np.arange(d)] * SCALE) + SHIFT
                fits = (np.abs(x) < _LONG).all(axis=1)  # false for nan too
            if fits.any():
                yield rows[fits], x[fits].astype(np.int64)


def _added(partials: DataFrame, schema: str, add: Callable[[list | None, dict], list], names: list[str]) -> pa.Table:
    """The partial sums of all tasks as one row, added up in two steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                total = add(total, row)
        if total is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, total, strict=True))], schema=batch.schema)

    some = partials.repartition(partitions(partials.sparkSession)).mapInArrow(run, schema)
    return some.repartition(1).mapInArrow(run, schema).toArrow()


def _block_rows(limit: int, d: int) -> int:
    """Rows whose products of at most ``limit`` add up exactly as doubles."""
    return max(1, min(1 << 14, _EXACT // max(1, limit), (1 << 22) // d))


def products(y: np.ndarray, most: int) -> np.ndarray:
    """The sum of the outer products of integer rows of at most ``most``, exact."""
    d = y.shape[1]
    out = np.zeros((d, d), np.int64)
    if most * most >= _EXACT:
        return y.T @ y
    step = _block_rows(most * most, d)
    for a in range(0, len(y), step):
        part = y[a:a + step].astype(np.float64)
        out += np.rint(part.T @ part).astype(np.int64)
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """G with G G' = v, a column for each pivot; its rows in the order of the
    pivots are a lower triangle."""
    d = len(v)
    g, left = np.zeros((d, d)), np.diag(v).astype(np.float64).copy()
    least = left.max(initial=0.0) * d * np.finfo(float).eps
    open_ = np.ones(d, bool)
    for k in range(d):
        pivot = int(np.where(open_, left, -np.inf).argmax())
        if not left[pivot] > least:
            return g[:, :k]
        column = (v[:, pivot] - g[:, :k] @ g[pivot, :k]) / np.sqrt(left[pivot])
        column[~open_] = 0.0  # earlier pivots: above the triangle
        column[pivot] = np.sqrt(left[pivot])
        g[:, k] = column
        open_[pivot] = False
        left -= column ** 2
    return g


def _rounds(r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Disjoint pairs of columns, round by round, that meet each pair once."""
    n = r + r % 2
    seats = np.arange(n)
    for _ in range(n - 1):
        a, b = seats[:n // 2], seats[n // 2:][::-1]
        real = (a < r) & (b < r)
        yield np.minimum(a, b)[real], np.maximum(a, b)[real]
        seats = np.concatenate([seats[:1], np.roll(seats[1:], 1)])


def jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of g g' in falling order and unit eigenvectors (columns): the
    columns of g are turned in pairs until they are orthogonal."""
    g = g.copy()
    small = np.finfo(float).eps * max(1, g.shape[1]) ** 0.5
    for _ in range(sweeps):
        turned = False
        for a, b in _rounds(g.shape[1]):
            x, y = g[:, a], g[:, b]
            p, q, both = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            go = np.abs(both) > small * np.sqrt(p * q)
            if not go.any():
                continue
            turned = True
            x, y, a, b = x[:, go], y[:, go], a[go], b[go]
            z = (q[go] - p[go]) / (2 * both[go])
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1.0, z))
            c = 1 / np.sqrt(1 + t * t)
            g[:, a], g[:, b] = c * (x - t * y), c * (y + t * x)
        if not turned:
            break
    norms = (g * g).sum(axis=0)
    order = np.argsort(-norms, kind="stable")
    return norms[order], g[:, order] / np.sqrt(norms[order])


@dataclass
class Whitening:
    """What the fit list says: its rows, sums, eigenvalues and components."""

    n: int
    sums: list[int]             # S, exact
    values: np.ndarray          # eigenvalues of V that are not 0, falling
    vectors: np.ndarray         # unit eigenvectors as columns
    trace: float
    most: int = 0               # greatest distance of an entry from its rounded mean

    @property
    def middle(self) -> np.ndarray:
        """The means as integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """S - n * middle: n times what rounding left of the means."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)]

    def projected(self, x: np.ndarray, k: int) -> np.ndarray:
        k = min(k, len(self.values))
        centred = (x - self.middle).astype(np.float64) - np.array(self.rest, np.float64) / max(1, self.n)
        return centred @ self.vectors[:, :k] / np.sqrt(self.values[:k])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exact."""
        y, rest = x - self.middle, self.rest
        if len(rest) * (self.n * (self.most + 1)) ** 2 < _LONG:
            return ((self.n * y - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in y.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def _fit_rows(vecs: DataFrame) -> tuple[int, int, list[int], int]:
    """Length, number, sums and (a bound of) the spread of the vectors."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for _, x in vectors(batch):
                t = total.setdefault(x.shape[1], [0, [0] * x.shape[1], x[0], x[0]])
                t[0] += len(x)
                t[1] = [s + p for s, p in zip(t[1], _column_sums(x), strict=True)]
                t[2], t[3] = np.minimum(t[2], x.min(axis=0)), np.maximum(t[3], x.max(axis=0))
        for d, (n, s, lo, hi) in total.items():
            yield pa.RecordBatch.from_pydict({"d": [d] * d, "i": list(range(d)), "n": [n] * d, "s": list(map(str, s)),
                                              "lo": lo, "hi": hi}, schema=_SUMS)

    found = stored(vecs.mapInArrow(sums, "d int, i int, n long, s string, lo long, hi long"), "vector-sums")
    most = found.filter("i = 0").groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not most:
        return 0, 0, [], 0
    d, n = most[0]
    rows = (found.filter(F.col("d") == d).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("lo").alias("lo"),
                                                           F.max("hi").alias("hi")).orderBy("i").collect())
    return d, n, [int(r.s) for r in rows], max(r.hi - r.lo for r in rows) + 1


_SUMS = pa.schema([("d", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("s", pa.string()), ("lo", pa.int64()), ("hi", pa.int64())])


def _column_sums(x: np.ndarray) -> list[int]:
    if len(x) * max(1, int(np.abs(x).max())) < _LONG:
        return x.sum(axis=0).tolist()
    return [sum(c) for c in x.T.tolist()]


def fitted(vecs: DataFrame) -> Whitening:
    """The whitening of the vectors in column ``v``."""
    d, n, sums, spread = _fit_rows(vecs)
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    w = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, spread)
    middle, rest = w.middle, np.array(w.rest, np.float64) / n
    exact = spread * spread * n < _LONG  # else: centred products in doubles

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), np.int64 if exact else np.float64)
        for batch in batches:
            for _, x in vectors(batch):
                if x.shape[1] != d:
                    continue
                if exact:
                    total += products(x - middle, spread)
                else:
                    y = (x - middle).astype(np.float64) - rest
                    total += y.T @ y
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]}, schema=pa.schema([("m", pa.binary())]))

    def add(total: list | None, row: dict) -> list:
        own = np.frombuffer(row["m"], np.int64 if exact else np.float64)
        return [(own if total is None else np.frombuffer(total[0], own.dtype) + own).tobytes()]

    got = _added(vecs.mapInArrow(scatter, "m binary"), "m binary", add, ["m"])["m"][0].as_py()
    if exact:
        y = np.frombuffer(got, np.int64).astype(object).reshape(d, d)
        r = np.array(w.rest, object)
        v = ((n * y - r[:, None] * r[None, :]) / (n * n)).astype(np.float64)
    else:
        v = np.frombuffer(got, np.float64).reshape(d, d) / n
    w.values, w.vectors = jacobi(pivoted_cholesky(v))
    w.trace = float(np.trace(v))
    return w


def identity_error(vecs: DataFrame, w: Whitening, components: int) -> float | None:
    """The greatest absolute entry of the projections' covariance less identity."""
    k = min(components, len(w.values))
    if not k:
        return None

    def merged(total: list | None, row: dict) -> list:
        if total is None:
            return [row["n"], row["mean"], row["m"]]
        n, m = total[0], row["n"]
        a, b = np.frombuffer(total[1]), np.frombuffer(row["mean"])
        gap = b - a
        both = np.frombuffer(total[2]) + np.frombuffer(row["m"]) + (np.outer(gap, gap) * (n * m / (n + m))).ravel()
        return [n + m, (a + gap * (m / (n + m))).tobytes(), both.tobytes()]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in vectors(batch):
                if x.shape[1] != len(w.sums):
                    continue
                p = w.projected(x, k)
                mean = p.mean(axis=0)
                p = p - mean
                total = merged(total, {"n": len(p), "mean": mean.tobytes(), "m": (p.T @ p).tobytes()})
        if total is not None:
            yield pa.RecordBatch.from_pydict({"n": [total[0]], "mean": [total[1]], "m": [total[2]]},
                                             schema=pa.schema([("n", pa.int64()), ("mean", pa.binary()), ("m", pa.binary())]))

    schema = "n long, mean binary, m binary"
    got = _added(vecs.mapInArrow(moments, schema), schema, merged, ["n", "mean", "m"])
    covariance = np.frombuffer(got["m"][0].as_py()).reshape(k, k) / got["n"][0].as_py()
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and
    identity_error: for each vector a row for each component."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    vecs = rows.select("v")
    w = fitted(vecs)
    d = len(w.sums)
    k = min(components, d)
    error = identity_error(vecs, w, k)
    explained = np.zeros(k)
    have = min(k, len(w.values))
    if w.trace > 0:
        explained[:have] = w.values[:have] / w.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in vectors(batch):
                if x.shape[1] != d:
                    continue
                for a in range(0, len(x), 2048):
                    part = x[a:a + 2048]
                    values = np.full((len(part), k), np.nan)
                    values[:, :have] = w.projected(part, k)
                    each = pa.array(np.repeat(np.arange(len(part)), k))
                    size = len(part) * k
                    yield pa.RecordBatch.from_arrays(
                        [batch["vec_id"].take(pa.array(at[a:a + 2048])).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                         pa.array(np.full(size, w.n)), pa.array(w.deviations(part), pa.int64()).take(each),
                         pa.array(values.ravel(), mask=np.isnan(values.ravel())), pa.array(np.tile(explained, len(part))),
                         pa.array([error] * size, pa.float64())],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
                                    "identity_error double")
