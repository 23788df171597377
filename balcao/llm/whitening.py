"""Whitening of embeddings by refined eigenvectors of their distributed covariance.

Each entry c of a vector becomes the whole number x = floor(64 * c) + 1000000. The
covariance V of these x, its eigenvectors and each row's whitened coordinates follow
in four passes over the table, none of which moves a vector:

1. count and sum per dimension (``_sums``), as Spark aggregates;
2. products of entries about the rounded mean: every task adds its own d x d whole
   numbers and sends one row per entry, which Spark sums. As they are whole numbers,
   V does not depend on how rows are spread;
3. the same sums over whitened values, for ``identity_error``;
4. the rows themselves.

Only d x d figures reach the driver. There, eigenvectors of V are found in float32
(``np.linalg.eigh``) and corrected by the iteration of Ogita and Aishima in extended
precision: with R = I - X'X and S = X'VX, one step X + XE removes the errors of
length and angle together and doubles the digits. Eigenvalues closer to each other than
the step can tell apart form a cluster; within it, the small problem
X_J'(V - mean I)X_J is solved anew, whose shift gives the differences all the
digits, and X_J is turned by its eigenvectors.

Defined cases. Rows are dropped whose vector is null, is empty, or holds null or
non-finite entries, or one beyond 2 ** 52 / 64 in size, which no double holds to the
unit. Of vectors that differ in length, the commonest length stays (the shorter, if
tied). ``deviation`` is null where it does not fit 64 bits. Components whose
eigenvalue is zero up to rounding have a null ``whitened``; if all are, as with one row or
equal rows, ``explained`` (where V is zero) and ``identity_error`` are null too. Repeated rows and null ids are
rows like others. No rows give no rows. Only vec_id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = 64
OFFSET = 1_000_000
COMPONENTS = 32

_LIMIT = float(1 << 52)
_EXACT = float(1 << 53)
_WIDE = np.longdouble
#: Refinement steps at most; from float32, three or four do.
_ROUNDS = 12
_BLOCK = 4096


@dataclass(frozen=True)
class Whitening:
    """n rows, sums per dimension, unit eigenvectors by row, eigenvalues and their shares of the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    shares: np.ndarray
    usable: np.ndarray


def _usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vec): rows that hold a finite vector, as doubles; of the commonest length."""
    held = rows.select("vec_id", F.col("vector").cast("array<double>").alias("vec"))
    entry_ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_LIMIT / STEPS))
    return held.filter(F.coalesce((F.size("vec") > 0) & F.forall("vec", entry_ok), F.lit(False)))


def _whole(c: str) -> str:
    return f"floor({STEPS} * {c}) + {OFFSET}"


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension of the commonest length."""
    lengths = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), "d").first()
    if top is None:
        return 0, []
    entries = rows.filter(F.size("vec") == top["d"]).select(F.posexplode("vec").alias("dim", "c"))
    sums = entries.groupBy("dim").agg(F.sum(F.expr(_whole("c")).cast("decimal(38,0)")).alias("s")).collect()
    return top["n"], [int(row["s"]) for row in sorted(sums, key=lambda row: row["dim"])]


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, n x d whole numbers as doubles) of runs of rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(start, _BLOCK)
            flat = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield part.column("vec_id"), np.floor(STEPS * flat) + OFFSET


def _covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance over all rows, divisor n, in extended precision.

    Entries are taken about the rounded mean m, so that products are small whole
    numbers; with y = x - m, V = (n * sum yy' - sum y sum y') / n**2 holds exactly.
    """
    d = len(sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.float64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, d):
            y = x - centre
            reach = np.abs(y).max(initial=1.0)
            step = int(max(1, min(_BLOCK, _EXACT // (reach * reach))))
            for i in range(0, len(y), step):
                made = y[i : i + step].T @ y[i : i + step]
                made = np.array([int(v) for v in made.ravel()], object) if reach > 1e5 else made.ravel().astype(np.int64)
                total = made if total is None else _added(total, made)
        if total is not None:
            place = pa.array(np.arange(d * d))
            yield pa.RecordBatch.from_arrays([place, pa.array([int(v) for v in total], pa.decimal128(38, 0))], ["place", "s"])

    parts = rows.mapInArrow(products, "place bigint, s decimal(38,0)")
    cross = parts.groupBy("place").agg(F.sum("s").alias("s")).collect()
    whole = [0] * (d * d)
    for row in cross:
        whole[row["place"]] = int(row["s"])
    y = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    out = np.empty((d, d), _WIDE)
    for i in range(d):
        for j in range(d):
            out[i, j] = _ratio(n * whole[i * d + j] - y[i] * y[j], n * n)
    return out


def _added(total: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Sum of whole numbers, beyond 64 bits where needed."""
    if total.dtype == object or made.dtype == object:
        return total.astype(object) + made.astype(object)
    if np.abs(total).max() > 1 << 61:
        return total.astype(object) + made.astype(object)
    return total + made


def _ratio(top: int, bottom: int) -> np.longdouble:
    """A quotient of whole numbers, to extended precision."""
    if not top:
        return _WIDE(0)
    scale = max(0, 80 - abs(top).bit_length() + bottom.bit_length())
    digits = (abs(top) << scale) // bottom
    cut = max(0, digits.bit_length() - 63)
    return (1 if top > 0 else -1) * np.ldexp(_WIDE(digits >> cut), cut - scale)


def refined(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns, to double precision and beyond."""
    a = np.asarray(v, _WIDE)
    scale = np.abs(a).max(initial=_WIDE(0))
    if not scale:
        return np.zeros(len(a), _WIDE), np.eye(len(a), dtype=_WIDE)
    a = a / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start.astype(_WIDE)
    for _ in range(_ROUNDS):
        x, values, moved = _step(a, x)
        x = _solve_clusters(a, x, values)
        if moved < 1e-17:
            break
    for _ in range(2):  # rounding in close pairs is all that is left to square up
        x = x + x @ (np.eye(len(a), dtype=_WIDE) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction of all eigenvectors: the new ones, the eigenvalues, and the largest change."""
    r = np.eye(len(a), dtype=_WIDE) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    unsure = 2 * (np.abs(off).sum(axis=1).max() + np.abs(a).sum(axis=1).max() * np.abs(r).sum(axis=1).max())
    apart = values[None, :] - values[:, None]
    clear = np.abs(apart) > unsure
    e = np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
    return x + x @ e, values, float(np.abs(e).max())


def _solve_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Turn the eigenvectors of close eigenvalues by the eigenvectors of their own small problem.

    The shift by the cluster's mean leaves only the differences of its eigenvalues, so
    double precision resolves them relative to each other. Clusters are runs of sorted
    eigenvalues with gaps that an ordinary step from here would not resolve well.
    """
    order = np.argsort(values, kind="stable")
    sorted_values = values[order]
    s = x.T @ (a @ x)
    loose = 2 * np.abs(s - np.diag(np.diag(s))).sum(axis=1).max() + np.finfo(_WIDE).eps * 8
    gaps = np.flatnonzero(np.diff(sorted_values) > loose) + 1
    x = x.copy()
    for members in np.split(order, gaps):
        if len(members) < 2:
            continue
        basis = x[:, members]
        basis = basis + basis @ ((np.eye(len(members), dtype=_WIDE) - basis.T @ basis) / 2)
        shift = values[members].mean()
        inner = basis.T @ (a @ basis - shift * basis)
        inner = (inner + inner.T) / 2
        size = np.abs(inner).max()
        if size:
            _, turn = np.linalg.eigh((inner / size).astype(np.float64))
            x[:, members] = basis @ turn.astype(_WIDE)
    return x


def fitted(rows: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The usable rows, and what whitens them (None without rows)."""
    held = _usable(rows)
    n, sums = _sums(held)
    if not n:
        return held, None
    held = held.filter(F.size("vec") == len(sums))
    values, x = refined(_covariance(held, n, sums))
    trace, kept = values.sum(), min(components, len(sums))
    usable = values[:kept] > values[0] * len(sums) * np.finfo(np.float64).eps
    shares = np.array([value / trace if trace > 0 else np.nan for value in values[:kept]], np.float64)
    vectors = np.ascontiguousarray(x[:, :kept].astype(np.float64))
    return held, Whitening(n, sums, vectors, values[:kept].astype(np.float64), shares, usable)


def _projected(fit: Whitening, x: np.ndarray) -> np.ndarray:
    """Whitened coordinates of rows; NaN for components without spread."""
    centre = [s // fit.n for s in fit.sums]
    rest = np.array([(s - c * fit.n) / fit.n for s, c in zip(fit.sums, centre, strict=True)])
    root = np.sqrt(np.where(fit.usable, fit.values, 1.0))
    out = ((x - np.array(centre, np.float64)) - rest) @ fit.vectors / root
    out[:, ~fit.usable] = np.nan
    return out


def _identity_error(rows: DataFrame, fit: Whitening) -> float | None:
    """Largest entry of the whitened values' covariance minus the identity, over all rows.

    Tasks send sums about their own means, which combine about the common mean.
    """
    used = np.flatnonzero(fit.usable)
    if not len(used):
        return None
    d, k = len(fit.sums), len(used)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, square = 0, np.zeros(k), np.zeros((k, k))
        for _, x in _matrices(batches, d):
            z = _projected(fit, x)[:, used]
            here, about = len(z), z.mean(axis=0)
            move, both = about - mean, count + here
            square += (z - about).T @ (z - about) + np.outer(move, move) * (count * here / both)
            mean, count = mean + move * (here / both), both
        if count:
            # Second moments about the common mean follow from these three sums.
            found = np.concatenate([square.ravel(), count * mean, (count * np.outer(mean, mean)).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["place", "s"])

    parts = rows.mapInArrow(products, "place bigint, s double").groupBy("place").agg(F.sum("s").alias("s"))
    found = np.zeros(2 * k * k + k)
    for row in parts.collect():
        found[row["place"]] = row["s"]
    mean = found[k * k : k * k + k] / fit.n
    between = found[k * k + k :].reshape(k, k) - fit.n * np.outer(mean, mean)
    return float(np.abs((found[: k * k].reshape(k, k) + between) / fit.n - np.eye(k)).max())


def _deviation(fit: Whitening, x: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2; null beyond 64 bits."""
    rough = fit.n * (x - np.array([s / fit.n for s in fit.sums]))
    if np.abs(x).max(initial=0) * fit.n < 2**62 and (rough * rough).sum(axis=1).max(initial=0) < 2**62:
        exact = fit.n * x.astype(np.int64) - np.array(fit.sums, np.int64)
        return (exact * exact).sum(axis=1).tolist()
    totals = [sum((fit.n * int(v) - s) ** 2 for v, s in zip(row, fit.sums, strict=True)) for row in x]
    return [total if total < 1 << 63 else None for total in totals]


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, vector) as one row per vector and component, the first ``components`` of them.

    vec_id, component, n, deviation, whitened, explained, identity_error.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, "
        "whitened double, explained double, identity_error double"
    )
    held, fit = fitted(rows, components)
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = _identity_error(held, fit)
    d, k = len(fit.sums), len(fit.values)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, d):
            m = len(x)
            spread = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(spread),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, fit.n)),
                    pa.array(_deviation(fit, x), pa.int64()).take(spread),
                    pa.array(_projected(fit, x).ravel(), from_pandas=True),
                    pa.array(np.tile(fit.shares, m), from_pandas=True),
                    pa.array([error] * (m * k), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return held.mapInArrow(described, schema)
