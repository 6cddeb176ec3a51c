"""Embeddings: cleaning, k-means, nearest centres, the two-dimensional map, and text features."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, HashingTF, Normalizer, PCAModel, StandardScaler, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticktalk.functions.messages import has_width
from ticktalk.functions.vectors import dense
from ticktalk.operators.kmeans import Centres, fit_centres
from ticktalk.operators.sets import drop_copies
from ticktalk.schemas import CENTROID
from ticktalk.session import settle

EMBEDDING_WIDTH = 768
CLUSTERS = 5
SEED = 1
MAX_CENTRE_VALUES = 8 << 20  # of a block of centres, which goes to every task
BLOCKS_AT_ONCE = 8


def clean_embeddings(df: DataFrame, width: int = EMBEDDING_WIDTH, vector: str = "embedding", keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows that have a vector of the expected width. Rows are checked before they are compared."""
    return drop_copies(df.where(has_width(vector, width)), keys)


def fit_clusters(
    df: DataFrame,
    k: int = CLUSTERS,
    seed: int = SEED,
    max_iter: int = 20,
    vector: str = "embedding",
    tolerance: float = 1e-4,
    start: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[Centres, DataFrame]:
    """(centres, ``df`` with a ``cluster`` column): see ``ticktalk.operators.kmeans``. ``start`` are the first centres, as ``collect_centres``
    returns them, instead of chosen ones. Rows without a usable vector have no cluster."""
    centres = fit_centres(df.select(vector), k, seed, max_iter, tolerance, start)
    return centres, attach_nearest(df, centres, vector)


def centres_of(centres: Centres, spark: SparkSession) -> DataFrame:
    rows = [(int(i), [float(x) for x in centre]) for i, centre in zip(centres.numbers, centres.matrix)]
    return spark.createDataFrame(rows, CENTROID)


def latest_centres(df: DataFrame, order: str | None = None) -> DataFrame:
    """One centre per cluster: the last by ``order``, or the greatest centre so that the choice is stable."""
    key = F.struct(order, "centroid") if order else F.struct("centroid")
    return df.groupBy("cluster").agg(F.max_by("centroid", key).alias("centroid"))


def collect_centres(centres: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(cluster numbers, matrix of centres), in order of cluster number; refuses what is too large to hand out at once."""
    rows, values = centres.agg(F.count("*"), F.coalesce(F.sum(F.size("centroid")), F.lit(0))).first()
    if values > MAX_CENTRE_VALUES:
        raise ValueError(f"{rows} centres hold {values} values, more than {MAX_CENTRE_VALUES}")
    return _as_matrix(centres.orderBy("cluster").collect())


def _as_matrix(found: Sequence) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.empty(0, np.int32), np.empty((0, 0))
    widths = {len(r.centroid) for r in found}
    if len(widths) != 1:
        raise ValueError(f"centres of different widths: {sorted(widths)}")
    return np.array([r.cluster for r in found], np.int32), np.array([r.centroid for r in found], np.float64)


def centre_blocks(centres: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The centres in order of cluster number, in blocks of at most ``MAX_CENTRE_VALUES`` values; one block at least."""
    held, values = [], 0
    for row in centres.orderBy("cluster").toLocalIterator():  # one partition of a sorted table at a time
        if held and values + len(row.centroid) > MAX_CENTRE_VALUES:
            yield _as_matrix(held)
            held, values = [], 0
        held.append(row)
        values += len(row.centroid)
    yield _as_matrix(held)


def nearest_centre(vector: Column | str, numbers: np.ndarray, matrix: np.ndarray) -> Column:
    """``struct(cluster, distance)`` of the nearest centre: the lowest number on a tie, and NULLs where there is
    none (no centres, no vector, a vector of another width, or no finite distance)."""
    return F.arrow_udf(nearest_centre_function(numbers, matrix), "struct<cluster: int, distance: double>")(vector)


def nearest_centre_function(numbers: np.ndarray, matrix: np.ndarray) -> Callable[[pa.Array], pa.Array]:
    width = matrix.shape[1]
    norms = np.sqrt((matrix**2).sum(axis=1))

    def nearest(vectors: pa.Array) -> pa.Array:
        sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        usable = np.flatnonzero((sizes == width) & (len(numbers) > 0))
        best = np.full(len(vectors), np.inf)
        cluster = np.zeros(len(vectors), np.int32)
        if len(usable):
            flat = vectors.take(pa.array(usable)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            points = flat.reshape(len(usable), width)
            lengths = np.sqrt((points**2).sum(axis=1))
            near = np.full(len(usable), np.inf)
            which = np.zeros(len(usable), np.int32)
            for number, centre, norm in zip(numbers, matrix, norms):
                # A centre is at least as far as the norms differ; the bound gives way to rounding.
                some = np.flatnonzero(~(np.abs(lengths - norm) * (1 - 1e-9) > near))
                if not len(some):
                    continue
                gap = np.sqrt(((points[some] - centre) ** 2).sum(axis=1))
                closer = gap < near[some]  # never true for NaN
                near[some[closer]], which[some[closer]] = gap[closer], number
            best[usable], cluster[usable] = near, which
        none = ~np.isfinite(best)
        return pa.StructArray.from_arrays(
            [pa.array(cluster, pa.int32(), mask=none), pa.array(best, pa.float64(), mask=none)], ["cluster", "distance"]
        )

    return nearest


def attach_nearest(
    df: DataFrame, centres: DataFrame | Centres, vector: str = "embedding", out: str = "cluster", distance: str | None = None
) -> DataFrame:
    """Add the number of the nearest centre, without a shuffle; works on streams too.

    Centres go to the tasks in blocks of ``MAX_CENTRE_VALUES`` values, and a row keeps the nearest of all blocks. After every
    ``BLOCKS_AT_ONCE`` blocks a batch table is written, so that no task holds more of them; a stream scores its micro-batches that way.
    """
    blocks = iter([(centres.numbers, centres.matrix)]) if isinstance(centres, Centres) else centre_blocks(centres)
    found, widths = df, set()
    for n, (numbers, matrix) in enumerate(blocks):
        widths.add(matrix.shape[1])
        if len(widths) > 1:
            raise ValueError(f"centres of different widths: {sorted(widths)}")
        if n and n % BLOCKS_AT_ONCE == 0 and not df.isStreaming:
            found = settle(found, "near")
        near = nearest_centre(vector, numbers, matrix)
        if n:
            found = found.withColumn("__new", near)
            closer = F.col("__near.distance").isNull() | (F.col("__new.distance") < F.col("__near.distance"))
            near = F.when(F.col("__new.distance").isNotNull() & closer, F.col("__new")).otherwise(F.col("__near"))
        found = found.withColumn("__near", near)
    columns = {out: F.col("__near.cluster")} | ({distance: F.col("__near.distance")} if distance else {})
    return found.withColumns(columns).drop("__near", "__new")


def fit_plane(df: DataFrame, vector: str = "embedding", components: int = 2) -> Callable[[DataFrame], DataFrame]:
    """Principal components of the centred vectors, as a function that adds the columns ``pca1, pca2, ...``.

    Each component is turned so that its largest loading is positive.
    """
    rows = df.select(dense(vector).alias("__raw"))
    centred = StandardScaler(inputCol="__raw", outputCol="__centred", withMean=True, withStd=False).fit(rows)
    plane: PCAModel = PCA(k=components, inputCol="__centred", outputCol="__pca").fit(centred.transform(rows))
    loadings = plane.pc.toArray()
    turn = [float(np.sign(column[np.abs(column).argmax()]) or 1.0) for column in loadings.T]

    def project(table: DataFrame) -> DataFrame:
        mapped = plane.transform(centred.transform(table.withColumn("__raw", dense(vector))))
        found = vector_to_array("__pca")
        added = {f"pca{i + 1}": found[i] * F.lit(turn[i]) for i in range(components)}
        return mapped.withColumns(added).drop("__raw", "__centred", "__pca")

    project.variance = [float(x) for x in plane.explainedVariance]
    project.loadings = loadings * np.array(turn)
    return project


def latent_map(df: DataFrame, hover: Sequence[str], vector: str = "embedding") -> DataFrame:
    """Position of every message on the plane with the columns shown next to it."""
    return fit_plane(df, vector)(df).select("pca1", "pca2", *hover)


def cluster_points(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size and centre of every cluster on the plane."""
    return df.groupBy(cluster).agg(F.count("*").alias("points"), F.avg("pca1").alias("pca1"), F.avg("pca2").alias("pca2"))


def hashed_embedding(df: DataFrame, text: str = "text", out: str = "embedding", width: int = EMBEDDING_WIDTH) -> DataFrame:
    """Add a unit vector of hashed word counts of the whole text; NULL text counts as empty, and empty text is zero."""
    steps = Pipeline(
        stages=[
            Tokenizer(inputCol="__text", outputCol="__words"),
            HashingTF(inputCol="__words", outputCol="__counts", numFeatures=width),
            Normalizer(inputCol="__counts", outputCol="__unit"),
        ]
    )
    ready = df.withColumn("__text", F.coalesce(text, F.lit("")))
    # None of the stages learns anything, so fitting reads no data.
    return steps.fit(ready).transform(ready).withColumn(out, vector_to_array("__unit", "float32")).drop("__text", "__words", "__counts", "__unit")


def model_embedding(load: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]]) -> Callable[[Column | str], Column]:
    """A column function for a user's own model: ``load`` runs once per task and returns ``texts -> vectors``."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            yield pd.Series([list(map(float, v)) for v in model(texts.fillna("").tolist())], index=texts.index)

    return embed
