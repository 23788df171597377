"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors are projected on several random subspaces, shifted, and placed on a Hilbert
curve in each. A curve's keys are cut at quantiles into ranges of about equal
numbers of rows, which Spark deals out; a query searches its own range and its
neighbours on every curve by exact Euclidean distance, and the finds of all curves
merge into its nearest.

Searched ranges are a share of the curve (``reach`` to each side), so that recall
does not fall as the table grows; small tables are one range, searched whole. How many ranges that is follows from
``range_rows``, the rows that one task holds. Equal vectors are one entry with its
smallest ids, so a vector that fills much of the table neither makes a range large
nor hides its neighbours.

Projections are scaled by means and deviations over all vectors. Vectors that are
null, zero, or hold null or non-finite components take no part, nor do rows without
id; vectors of a length other than the most frequent one (the longer if two are
equally frequent) take no part either. An id that occurs again with another vector
is another row; its distance is given for each row once. With fewer candidates than
wanted, all that lie in the searched ranges are returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.sources.scratch import stage

CURVES, DIMENSIONS, BITS = 16, 8, 8
RANGES, REACH, RANGE_ROWS = 32, 1 / 32, 20_000
NEAREST = 10


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cell numbers (below 2**bits) on the Hilbert curve of its dimensions.

    Gray-code walk from the coarsest bit to the finest: each level's quadrant decides
    how the finer axes are swapped or mirrored, then the bits of all axes interleave.
    """
    axes = np.ascontiguousarray(cells.T, dtype=np.uint32)
    d = len(axes)
    for level in range(bits - 1, 0, -1):
        top, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for axis in range(d):
            upper = (axes[axis] & top) != 0
            swap = np.where(upper, np.uint32(0), (axes[0] ^ axes[axis]) & low)
            axes[0] ^= np.where(upper, low, swap)
            axes[axis] ^= swap
    for axis in range(1, d):
        axes[axis] ^= axes[axis - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((axes[d - 1] >> np.uint32(level)) & 1, np.uint32((1 << level) - 1), np.uint32(0))
    axes ^= turn
    key = np.zeros(axes.shape[1], dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in range(d):
            key = (key << np.uint64(1)) | ((axes[axis] >> np.uint32(level)) & np.uint32(1)).astype(np.uint64)
    return key


def _usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 1)


def _curves(mean: np.ndarray, dimensions: int, curves: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A projection and a shift for each curve, the same for every run."""
    rng = np.random.default_rng(seed)
    used = min(dimensions, len(mean))
    made = []
    for _ in range(curves):
        basis, _ = np.linalg.qr(rng.standard_normal((len(mean), used)))
        made.append((basis, rng.random(used) * 0.25))
    return made


def _placed(curves, mean: np.ndarray, spread: list[np.ndarray], bits: int) -> Callable:
    """Adds a row per curve with the Hilbert key of each vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector")) - mean
            for curve, ((basis, shift), scale) in enumerate(zip(curves, spread, strict=True)):
                inside = np.clip(x @ basis / scale / 6 + 0.5, 0, 1)
                cells = ((inside + shift) / 1.25 * ((1 << bits) - 1)).astype(np.uint32)
                key = (hilbert_keys(cells, bits) ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), curve, np.int32)), pa.array(key), *batch.columns],
                    ["curve", "key", *batch.schema.names],
                )

    return place


def _searched(nearest: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Exact distances of a range's queries to its entries; the nearest of each are kept."""

    def search(entries: pa.Table, queries: pa.Table) -> pa.Table:
        asked, found, ids, distance = [], [], [], []
        if entries.num_rows and queries.num_rows:
            x, q = _matrix(entries.column("vector")), _matrix(queries.column("vector"))
            names, own = entries.column("entry").to_numpy(), queries.column("entry").to_numpy()
            kept = min(nearest + 1, len(x))
            squares = (x * x).sum(axis=1)
            least, place = np.unique(entries.column("least").to_numpy(zero_copy_only=False), return_inverse=True)
            for i in range(len(q)):
                # Squared distances but for the query's own square, with the rounding they may have.
                rough = squares - 2 * (x @ q[i])
                slack = 1e-15 * (x.shape[1] + 8) * (squares.max() + q[i] @ q[i])
                near = np.flatnonzero(rough <= np.partition(rough, kept - 1)[kept - 1] + 2 * slack)
                exact = np.sqrt(((x[near] - q[i]) ** 2).sum(axis=1))
                order = np.lexsort((place[near], exact))[:kept]
                asked.append(np.full(kept, own[i]))
                found.append(names[near[order]])
                ids.append(least[place[near[order]]])
                distance.append(exact[order])
        none = np.empty(0)
        return pa.table(
            {
                "query": pa.array(np.concatenate(asked) if asked else none.astype(np.int64)),
                "entry": pa.array(np.concatenate(found) if found else none.astype(np.int64)),
                "least": pa.array(np.concatenate(ids) if ids else [], entries.schema.field("least").type),
                "score": pa.array(np.concatenate(distance) if distance else none),
            }
        )

    return search


def _entries(rows: DataFrame, nearest: int) -> tuple[DataFrame, DataFrame]:
    """(entry, vector, least id) of distinct vectors, and (entry, vec_id, nth) with the smallest ids of each."""
    named = rows.withColumn("entry", F.xxhash64("vector"))
    nth = F.row_number().over(Window.partitionBy("entry").orderBy("vec_id"))
    ids = named.select("entry", "vec_id", nth.alias("nth")).filter(F.col("nth") <= nearest + 1)
    return named.groupBy("entry").agg(F.first("vector").alias("vector"), F.min("vec_id").alias("least")), ids


def nearest(
    vectors: DataFrame,
    is_query: Column,
    count: int = NEAREST,
    curves: int = CURVES,
    reach: float = REACH,
    range_rows: int = RANGE_ROWS,
    seed: int = 11,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score for rows (vec_id, vector) where ``is_query`` holds."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    most = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    width = most.n if most else 1
    rows = stage(rows.filter(F.size("vector") == width).select("vec_id", "vector", is_query.alias("asks")), "vetores")
    entries, ids = _entries(rows, count)
    entries, ids = stage(entries, "entradas"), stage(ids, "ids")
    asking = rows.filter("asks").select("vec_id", F.xxhash64("vector").alias("query")).distinct()
    asking = stage(asking, "perguntas")

    total = entries.count()
    parts = F.posexplode("vector").alias("at", "x")
    moments = entries.select(parts).groupBy("at").agg(F.avg("x").alias("mean")).orderBy("at").collect()  # one per component
    mean = np.array([row["mean"] for row in moments]) if moments else np.zeros(width)
    made = _curves(mean, DIMENSIONS, curves, seed)
    deviation = _deviations(entries, made, mean)
    placed = stage(entries.mapInArrow(_placed(made, mean, deviation, BITS), f"curve int, key bigint, {_fields(entries)}"), "curvas")

    # A range holds several times the wanted neighbours, so small tables are few ranges, or one.
    ranges = max(1, min(RANGES, total // (4 * count)), -(-total // range_rows))
    aside = max(1, int(np.ceil(reach * ranges)))
    shares = [i / ranges for i in range(1, ranges)]
    quantiles = F.percentile_approx("key", shares, F.lit(max(10_000, 20 * ranges))) if shares else F.array().cast("array<bigint>")
    cuts = placed.groupBy("curve").agg(quantiles.alias("cuts"))
    ranged = stage(
        placed.join(F.broadcast(cuts), "curve").select(
            "curve", _range_of("key", "cuts").alias("range"), "entry", "vector", "least"
        ),
        "faixas",
    )
    once = asking.select("query").distinct()
    around = F.explode(F.sequence(F.col("range") - aside, F.col("range") + aside)).alias("range")
    queries = ranged.join(once, F.col("entry") == F.col("query"), "left_semi").select(
        *[F.col(c).alias(c) for c in ("curve", "entry", "vector")], around
    )
    hits = ranged.groupBy("curve", "range").cogroup(queries.groupBy("curve", "range")).applyInArrow(
        _searched(count), f"query bigint, entry bigint, least {entries.schema['least'].dataType.simpleString()}, score double"
    )
    merged = hits.groupBy("query", "entry").agg(F.min("score").alias("score"), F.min("least").alias("least"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "least"))
    few = merged.withColumn("place", place).filter(F.col("place") <= count + 1)

    # Ties of distance go to smaller ids: each entry before the cut has a pair before all pairs of those after it.
    named = few.select("query", "entry", "score").join(ids, "entry")
    pairs = asking.select(F.col("vec_id").alias("query_id"), "query").join(named, "query")
    pairs = pairs.filter((F.col("query") != F.col("entry")) | (F.col("query_id") != F.col("vec_id")))
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return (
        pairs.withColumn("rank", rank).filter(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
    )


def _fields(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _range_of(key: str, cuts: str) -> Column:
    """Number of cuts below the key, by halving; equal cuts leave ranges empty."""
    return F.size(F.filter(cuts, lambda cut: cut < F.col(key)))


def _deviations(entries: DataFrame, made, mean: np.ndarray) -> list[np.ndarray]:
    """Standard deviation along every projection, from one sum of squares per task."""

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector")) - mean
            for curve, (basis, _) in enumerate(made):
                total = ((x @ basis) ** 2).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(total), curve, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), len(x)))],
                    ["curve", "axis", "total", "n"],
                )

    sums = entries.mapInArrow(squares, "curve int, axis int, total double, n bigint").groupBy("curve", "axis")
    found = {(r.curve, r.axis): r.total / r.n for r in sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()}
    return [
        np.array([max(found.get((c, a), 1.0), 1e-30) ** 0.5 for a in range(basis.shape[1])])
        for c, (basis, _) in enumerate(made)
    ]
