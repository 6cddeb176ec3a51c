"""K-means whose result does not depend on how rows are laid out.

Sums are whole numbers: entries count in steps of ``2**-STEPS`` of the largest one and cluster sums are exact, whatever the order of adding. Random
choices are hashes of the vector itself. So one partition or many, in any order, give the same centres; equal vectors are alike.

A pass over the vectors sends one row per task and cluster. The driver holds the centres, and while they are chosen
some thousand candidates (``OVERSAMPLING`` times ``k`` per round are expected, however large the table).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

STEPS = 32
ROUNDS, OVERSAMPLING = 2, 2
_COST_STEPS = 20
GATHERED = 1 << 20  # sums of so many entries, of all tasks together, are added up by the driver; more by a shuffle


@dataclass(frozen=True)
class Centres:
    """Cluster numbers and centres."""

    numbers: np.ndarray
    matrix: np.ndarray

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802
        return list(self.matrix)


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """Usable vectors of a batch: of the width, all entries finite."""
    for batch in batches:
        column = batch.column(0)
        sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(sizes == width)
        points = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), width)
        yield points[np.isfinite(points).all(axis=1)]


def _nearest(points: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest centre, the first of equal ones, and the square of its distance."""
    best, place = np.full(len(points), np.inf), np.zeros(len(points), np.int64)
    for i, centre in enumerate(matrix):
        gap = ((points - centre) ** 2).sum(axis=1)
        closer = gap < best
        best[closer], place[closer] = gap[closer], i
    return place, best


def _sums(matrix: np.ndarray, exponent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task and centre: number of its vectors, sums of their entries, and of their squared distances, in whole steps."""
    k, width = matrix.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 2), np.int64)
        for points in _matrices(batches, width):
            place, gap = _nearest(points, matrix)
            steps = np.rint(np.ldexp(points, STEPS - exponent)).astype(np.int64)
            for i in np.unique(place):
                mine = place == i
                total[i, :width] += steps[mine].sum(axis=0)
                total[i, width:] += [mine.sum(), np.rint(np.ldexp(gap[mine], _COST_STEPS - 2 * exponent)).astype(np.int64).sum()]
        some = np.flatnonzero(total[:, width])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(list(total[some]), pa.list_(pa.int64()))], ["place", "sums"])

    return rows


def _totals(vectors: DataFrame, matrix: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(centre of mass of each centre's vectors, how many there are, sum of squared distances). No entry is above ``2**exponent``."""
    k, width = matrix.shape
    parts = vectors.mapInArrow(_sums(matrix, exponent), "place int, sums array<long>")
    total = [[0] * (width + 2) for _ in range(k)]
    if vectors.rdd.getNumPartitions() * k * width <= GATHERED:
        for row in parts.collect():
            total[row["place"]] = [x + y for x, y in zip(total[row["place"]], row["sums"])]
    else:
        each = parts.select("place", F.posexplode("sums").alias("column", "x"))
        for row in each.groupBy("place", "column").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():  # one row per entry
            total[row["place"]][row["column"]] = int(row["x"])
    counts = np.array([row[width] for row in total], np.int64)
    moved = matrix.copy()
    for i in np.flatnonzero(counts):
        moved[i] = [math.ldexp(x / (total[i][width] << STEPS), exponent) for x in total[i][:width]]
    return moved, counts, math.ldexp(sum(row[width + 1] for row in total), 2 * exponent - _COST_STEPS)


def _uniform(points: np.ndarray, salt: str) -> np.ndarray:
    """A number in [0, 1) for each vector, by its bytes."""
    return np.array([int.from_bytes(hashlib.blake2b(p.tobytes(), digest_size=8, salt=salt.encode()).digest(), "big") / 2**64 for p in points])


def _drawn(matrix: np.ndarray, chance: float, salt: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Vectors drawn with a chance in proportion to the square of their distance from the centres."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points in _matrices(batches, matrix.shape[1]):
            _, gap = _nearest(points, matrix)
            taken = points[_uniform(points, salt) < gap * chance]
            yield pa.RecordBatch.from_arrays([pa.array(list(taken), pa.list_(pa.float64()))], ["v"])

    return rows


def _finite(vector: str) -> Column:
    return F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def choose_centres(vectors: DataFrame, k: int, seed: int, width: int, exponent: int) -> np.ndarray:
    """First centres: rounds of oversampling by distance, then k-means++ among the candidates weighted by their vectors."""
    usable = vectors.where((F.size("v") == width) & _finite("v"))
    first = usable.select(F.min(F.struct(F.xxhash64(F.lit(seed), "v"), F.col("v"))).alias("r")).first()["r"]
    found = np.array([first[1]], np.float64)
    for turn in range(ROUNDS):
        _, _, cost = _totals(vectors, found, exponent)
        if not cost:
            break
        chance = OVERSAMPLING * k / cost
        drawn = vectors.mapInArrow(_drawn(found, chance, f"{seed}-{turn}"), "v array<double>").distinct().collect()
        if drawn:
            found = np.unique(np.vstack([found, [r["v"] for r in drawn]]), axis=0)
    _, weights, _ = _totals(vectors, found, exponent)
    rng = np.random.default_rng(seed)
    chosen = [int(np.argmax(weights))]
    gap = ((found - found[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(found)):
        pull = np.cumsum(gap * weights)
        if not pull[-1]:
            break
        chosen.append(int(np.searchsorted(pull, rng.random() * pull[-1], side="right").clip(max=len(found) - 1)))
        gap = np.minimum(gap, ((found - found[chosen[-1]]) ** 2).sum(axis=1))
    return found[chosen]


def fit_centres(
    vectors: DataFrame, k: int, seed: int, max_iter: int, tolerance: float, start: tuple[np.ndarray, np.ndarray] | None = None
) -> Centres:
    """Centres of the vectors in the only column of ``vectors``. Vectors that are null, hold entries that are not finite, or are not of the
    most frequent width are left out. There are fewer than ``k`` centres if there are fewer different vectors, and none without any. A centre
    that loses all its vectors stays where it is. Centres stop moving when none of them is ``tolerance`` away from its last place."""
    rows = vectors.select(F.col(vectors.columns[0]).alias("v")).where(F.col("v").isNotNull())
    largest = F.max(F.when(_finite("v"), F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))))
    widths = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), largest.alias("largest"))
    if start is not None:
        widths = widths.where(F.col("width") == start[1].shape[1])
    usual = widths.agg(F.max(F.struct("n", "width", "largest")).alias("r")).first()["r"]
    if usual is None or usual["largest"] is None:
        return Centres(np.empty(0, np.int32), np.empty((0, 0))) if start is None else Centres(*start)
    exponent = math.frexp(usual["largest"])[1]
    if start is None:
        matrix = choose_centres(rows, k, seed, usual["width"], exponent)
        numbers = np.arange(len(matrix), dtype=np.int32)
    else:
        numbers, matrix = start
    for _ in range(max_iter):
        moved, _, _ = _totals(rows, matrix, exponent)
        step = np.sqrt(((moved - matrix) ** 2).sum(axis=1)).max(initial=0)
        matrix = moved
        if step <= tolerance:
            break
    return Centres(np.asarray(numbers, np.int32), matrix)
