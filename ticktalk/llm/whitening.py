"""Whitening of embeddings: exact covariance in whole numbers, float32 eigenvectors refined in higher precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import query, table

GRID, SHIFT = 64, 1_000_000  # an entry c becomes floor(GRID * c) + SHIFT
COMPONENTS = 32
LARGEST = 2.0**40 / GRID  # entries beyond count as not finite
LIMB = 18  # bits of a part of a centred entry: products of parts add up exactly in float64
ENTRIES = 1 << 20  # entries of vectors held at once as numbers


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: ``n`` vectors, ``sums`` of floor(GRID * c), eigenvalues and unit eigenvectors (as columns) by falling
    eigenvalue, their share of the trace, and how far the covariance of the whitened vectors is from the identity."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None


def usable(vectors: Column) -> Column:
    """Whether a vector is there, not empty, and all its entries are finite."""
    fine = F.forall(vectors, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False)))
    return F.coalesce(fine & (F.size(vectors) > 0), F.lit(False))


def _grids(batches: Iterator[pa.RecordBatch], size: int | None = None):
    """(rows of a batch, their grid numbers as a matrix), in slices of bounded size; by vector size if none is given."""
    for batch in batches:
        sizes = pa.compute.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
        for wanted in [size] if size else np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == wanted)
            step = max(1, ENTRIES // wanted)
            for first in range(0, len(rows), step):
                part = batch.take(pa.array(rows[first : first + step]))
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield part, np.floor(flat * GRID).astype(np.int64).reshape(-1, wanted)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for part, grid in _grids(batches):
        size = grid.shape[1]
        total[size] = total.get(size, 0) + np.append(grid.sum(axis=0), part.num_rows)
    for size, sums in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([sums], pa.list_(pa.int64()))], ["size", "sums"])


def _products(size: int, middle: np.ndarray):
    """Sums of products of centred entries, in parts of ``LIMB`` bits so that each float64 product sum is a whole number without error."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for _, grid in _grids(batches, size):
            rest, limbs = grid - middle, []
            while rest.any():
                low = ((rest + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
                limbs.append(low.astype(np.float64))
                rest = (rest - low) >> LIMB
            for a, left in enumerate(limbs):
                for b, right in enumerate(limbs):
                    total[a, b] = total.get((a, b), 0) + (left.T @ right).astype(np.int64)
        for (a, b), matrix in total.items():
            shifts = pa.array([LIMB * (a + b)] * size, pa.int32())
            yield pa.RecordBatch.from_arrays([shifts, pa.array(np.arange(size), pa.int32()), pa.array(list(matrix), pa.list_(pa.int64()))], ["shift", "row", "sums"])

    return rows


def _added(parts: DataFrame, *keys: str, kind: str = "decimal(38,0)"):
    """Arrays of equal keys added up entry by entry; as many rows come back as these small matrices have entries."""
    each = parts.select(*keys, F.posexplode("sums").alias("place", "x"))
    return each.groupBy(*keys, "place").agg(F.sum(F.col("x").cast(kind)).alias("x")).collect()


def covariance(vectors: DataFrame) -> tuple[int, tuple[int, ...], np.ndarray]:
    """Number of vectors, sums of their grid numbers, and the numerators of the exact covariance over the square of that number.

    ``vectors`` has one column ``vector`` of usable vectors. Those whose size is not the most frequent one (of equal ones the largest) are
    left out. Entries are centred by the rounded mean before they are multiplied; what the rounding leaves is corrected in whole numbers.
    """
    found: dict[int, dict[int, int]] = {}
    for row in _added(vectors.mapInArrow(_sums, "size long, sums array<long>"), "size"):
        found.setdefault(row["size"], {})[row["place"]] = int(row["x"])
    if not found:
        return 0, (), np.empty((0, 0), object)
    size = max(found, key=lambda s: (found[s][s], s))
    n, sums = found[size][size], tuple(found[size][i] for i in range(size))
    middle = [(2 * s + n) // (2 * n) for s in sums]
    products = np.zeros((size, size), object)
    parts = vectors.mapInArrow(_products(size, np.array(middle, np.int64)), "shift int, row int, sums array<long>")
    for row in _added(parts, "shift", "row"):
        products[row["row"], row["place"]] += int(row["x"]) << row["shift"]
    rest = np.array([s - n * m for s, m in zip(sums, middle)], object)
    return n, sums, n * products - np.outer(rest, rest)


def _wide(numerators: np.ndarray, divisor: int) -> np.ndarray:
    """Exact quotients rounded to extended precision."""
    out = np.empty(numerators.shape, np.longdouble)
    for place, number in np.ndenumerate(numerators):
        high = number / divisor
        out[place] = np.longdouble(high) + np.longdouble(float(Fraction(number, divisor) - Fraction(high)))
    return out


def _components_of(touching: np.ndarray) -> list[np.ndarray]:
    """Index sets of more than one place that are connected by ``touching``."""
    left, sets = set(range(len(touching))), []
    while left:
        front, group = [left.pop()], set()
        while front:
            i = front.pop()
            group.add(i)
            near = left & set(np.flatnonzero(touching[i]).tolist())
            left -= near
            front += near
        if len(group) > 1:
            sets.append(np.array(sorted(group)))
    return sets


def refined_eigenvectors(matrix: np.ndarray, most_steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix in extended precision.

    Start: eigenvectors in float32. A step takes the residuals of orthogonality and of the eigenvalue equation by matrix multiplication in
    extended precision, and corrects each vector by the others; the error is squared by each step. Where eigenvalues are too close for
    their residuals, the vectors of the cluster are first turned among themselves by a small eigenproblem of the matrix shifted by the
    cluster's mean, solved in float64. Equal eigenvalues keep any orthonormal basis.
    """
    size = len(matrix)
    scale = np.abs(matrix).max()
    if not scale:
        return np.zeros(size, np.longdouble), np.eye(size, dtype=np.longdouble)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    epsilon = np.finfo(np.longdouble).eps
    identity, diagonal = np.eye(size, dtype=np.longdouble), np.eye(size, dtype=bool)

    def residuals(x):
        r, s = identity - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        return r, s, values, values[None, :] - values[:, None], s + (values[None, :] + values[:, None]) / 2 * r

    for _ in range(most_steps):
        r, s, values, gaps, off = residuals(x)
        equal = np.abs(gaps) <= 64 * size * epsilon
        turned = False
        for group in _components_of((np.abs(off) > np.abs(gaps) / 64) & ~equal & ~diagonal):
            within = np.ix_(group, group)
            mean = values[group].mean()
            small = s[within] - mean * (identity[within] - r[within])
            small = (small + small.T) / 2
            turn = np.linalg.eigh((small / np.abs(small).max()).astype(np.float64))[1]
            x[:, group] = x[:, group] @ turn.astype(np.longdouble)
            turned = True
        if turned:
            r, s, values, gaps, off = residuals(x)
            equal = np.abs(gaps) <= 64 * size * epsilon
        ratio = off / np.where(equal | diagonal, 1, gaps)
        # The ratio turns two vectors by opposite angles, half the residual of orthogonality goes to each of them. What a cluster's own
        # eigenproblem could not separate waits for the next step.
        step = r / 2 + np.where(~equal & ~diagonal & (np.abs(ratio) <= 0.25), ratio, 0)
        x = x + x @ step
        if np.abs(step).max() <= 16 * size * epsilon and not turned:
            break
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _whitened(n: int, sums: tuple[int, ...], axes: np.ndarray):
    """Rows to ``id, deviation, whitened`` by the scaled eigenvectors in ``axes``."""
    size = len(sums)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([float(Fraction(s - n * int(m), n)) for s, m in zip(sums, middle)])

    def deviations(grid: np.ndarray) -> list[int | None]:
        whole = n * int(np.abs(grid).max(initial=0)) + max(map(abs, sums)) < 1 << 62
        apart = (grid * n - np.array(sums, np.int64)) if whole else (grid.astype(object) * n - np.array(sums, object))
        if whole and (apart.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 2.0**62:
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum(int(x) ** 2 for x in row) for row in apart]
        return [x if x < 1 << 63 else None for x in exact]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, grid in _grids(batches, size):
            projected = ((grid - middle) - rest) @ axes
            ends = pa.array(np.arange(len(grid) + 1) * axes.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(projected.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(deviations(grid), pa.int64()), lists], ["id", "deviation", "whitened"])

    return rows


def _spread(width: int):
    """Sums of the whitened entries and of their products."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            z = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total += np.vstack([z.T @ z, z.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["row", "sums"])

    return rows


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Whitening]:
    """(``id, deviation, whitened``, what was fitted): one row per usable vector of the usual size.

    Vectors that are null, empty, or hold null, NaN, infinite or huge (``LARGEST``) entries are left out, and so are those whose size is not
    the most frequent one. Components without variance (constant or dependent entries, fewer vectors than entries) are not there, so
    ``whitened`` may be shorter than ``components``, or empty. ``deviation`` is exact and null where it exceeds 64 bits. Null and repeated
    ids are kept; other columns change nothing. No vectors: no rows.

    Three passes read the vectors. Only sums leave a task: one matrix as wide as a vector, which is added up by entry.
    """
    held = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(usable(F.col("vector")))
    n, sums, numerators = covariance(held.select("vector"))
    if not n:
        empty = held.limit(0).select("id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return empty, Whitening(0, (), np.empty(0), np.empty((0, 0)), np.empty(0), None)
    values, vectors = refined_eigenvectors(_wide(numerators, n * n))
    trace = Fraction(sum(np.diag(numerators)), n * n)
    kept = int((values > float(trace) * len(sums) * 1e-15).sum()) if trace else 0
    kept = min(kept, components)
    values, vectors = values[:kept], vectors[:, :kept]
    axes = (vectors / np.sqrt(values)).astype(np.float64)
    kind = rows.schema[id_col].dataType.simpleString()
    out = held.mapInArrow(_whitened(n, sums, axes), f"id {kind}, deviation long, whitened array<double>")
    error = None
    if kept:
        spread = np.zeros((kept + 1, kept))
        for row in _added(out.mapInArrow(_spread(kept), "row int, sums array<double>"), "row", kind="double"):
            spread[row["row"], row["place"]] = row["x"] / n
        middle = spread[kept]
        error = float(np.abs(spread[:kept] - np.outer(middle, middle) - np.eye(kept)).max())
    return out, Whitening(n, sums, values.astype(np.float64), vectors.astype(np.float64), (values / np.longdouble(float(trace or 1))).astype(np.float64), error)


@query()
def op13_whitening(spark, sf_dir):
    rows, fit = whiten(table(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(float(x)) for x in fit.explained]).cast("array<double>")
    each = rows.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(fit.identity_error).cast("double").alias("identity_error"),
    )
