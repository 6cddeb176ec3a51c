"""Vector queries: nearest centres, k-means, the plane, and text features."""

from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ticktalk.catalog.registry import query, table
from ticktalk.functions.vectors import dense, plain
from ticktalk.operators import clusters
from ticktalk.session import scratch_path
from ticktalk.sinks.files import write_centres
from ticktalk.sources.files import read_centres

LABEL_MEANS = """
    means AS (SELECT label, list(m ORDER BY i) AS centre FROM (
        SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i)
        GROUP BY label),
    scored AS (SELECT vec_id, arg_min(m.label, (d, m.label)) AS cluster, min(d) AS distance FROM (
        SELECT vec_id, means.label, list_distance(CAST(embedding AS DOUBLE[]), centre) AS d FROM embeddings, means) AS m
        GROUP BY vec_id)"""


def label_means(spark, d):
    rows = table(spark, d, "embeddings").withColumn("v", dense("embedding"))
    means = rows.groupBy(F.col("label").alias("cluster")).agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select("cluster", plain("m").alias("centroid"))


@query(f"WITH {LABEL_MEANS} SELECT vec_id, cluster, round(distance, 6) AS distance FROM scored")
def nearest_centroid(spark, d):
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    near = clusters.attach_nearest(vectors, label_means(spark, d), distance="distance")
    return near.select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@query("""
    SELECT DISTINCT round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total, len(embedding) AS width, label,
           round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * i)), 6) AS weighted FROM embeddings WHERE len(embedding) = 64""")
def clean_embeddings(spark, d):
    """Every vector delivered twice."""
    twice = table(spark, d, "embeddings").drop("vec_id")
    kept = clusters.clean_embeddings(twice.unionByName(twice), 64)
    add = lambda values: F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6)
    weighted = F.transform("embedding", lambda x, i: x.cast("double") * (i + 1))
    plain_sum = F.transform("embedding", lambda x: x.cast("double"))
    return kept.select(add(plain_sum).alias("total"), F.size("embedding").cast("bigint").alias("width"), "label", add(weighted).alias("weighted")).distinct()


@query()
def kmeans_labels(spark, d):
    _, labelled = clusters.fit_clusters(table(spark, d, "embeddings"))
    return labelled.select("vec_id", "cluster")


@query()
def kmeans_short(spark, d):
    _, labelled = clusters.fit_clusters(table(spark, d, "embeddings"), max_iter=5)
    return labelled.select("vec_id", "cluster")


def _lloyd(steps):
    """SQL of Lloyd steps from the mean vector of each label: names ``c0, c1, ...`` of (cluster, centre) and ``s0, ...`` of (vec_id, cluster)."""
    means = """SELECT cluster, list(m ORDER BY i) AS centre FROM (SELECT cluster, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
        FROM {rows}, (SELECT unnest(range(1, 65)) AS i) GROUP BY cluster, i) GROUP BY cluster"""
    parts = ["c0 AS MATERIALIZED (" + means.format(rows="(SELECT label AS cluster, embedding FROM embeddings)") + ")"]
    for n in range(steps):
        parts.append(f"""s{n} AS MATERIALIZED (SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, any_value(embedding) AS embedding FROM (
            SELECT vec_id, embedding, cluster, list_distance(CAST(embedding AS DOUBLE[]), centre) AS d FROM embeddings, c{n}) GROUP BY vec_id)""")
        parts.append(f"c{n + 1} AS MATERIALIZED (" + means.format(rows=f"s{n}") + ")")
    return ", ".join(parts)


def _from_means(spark, d, steps):
    start = clusters.collect_centres(label_means(spark, d))
    return clusters.fit_clusters(table(spark, d, "embeddings"), max_iter=steps, tolerance=0.0, start=start)


@query(f"""
    WITH {_lloyd(5)} SELECT cluster, i - 1 AS place, round(centre[i], 5) AS value FROM c5, (SELECT unnest(range(1, 65)) AS i)""")
def kmeans_centres(spark, d):
    """Centres after five steps from the mean vector of each label."""
    centres = clusters.centres_of(_from_means(spark, d, 5)[0], spark)
    return centres.select("cluster", F.posexplode("centroid").alias("place", "value")).select("cluster", F.col("place").cast("long").alias("place"), F.round("value", 5).alias("value"))


@query(f"WITH {_lloyd(4)} SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster FROM (SELECT vec_id, cluster, list_distance(CAST(embedding AS DOUBLE[]), centre) AS d FROM embeddings, c4) GROUP BY vec_id")
def kmeans_from_means(spark, d):
    """Labels after four steps from the mean vector of each label."""
    return _from_means(spark, d, 4)[1].select("vec_id", "cluster")


@query("SELECT vec_id, TRUE AS label_is_nearest FROM embeddings")
def kmeans_centres_roundtrip(spark, d):
    """Centres are exported and read back; the label of every vector has to be its nearest exported centre."""
    model, labelled = clusters.fit_clusters(table(spark, d, "embeddings"))
    path = scratch_path(spark, "centres")
    write_centres(clusters.centres_of(model, spark), path)
    near = clusters.attach_nearest(labelled, read_centres(spark, path), out="near")
    return near.select("vec_id", (F.col("near") == F.col("cluster")).alias("label_is_nearest"))


@query()
def pca_map(spark, d):
    return clusters.latent_map(table(spark, d, "embeddings"), ["vec_id", "label"])


@query("""
    WITH means AS (SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY i)
    SELECT vec_id, round(sum(power(CAST(embedding[i] AS DOUBLE) - m, 2)), 5) AS squared FROM embeddings, means GROUP BY vec_id""")
def pca_distances(spark, d):
    """All components of a vector together are as far from the middle as the vector itself."""
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    mapped = clusters.fit_plane(vectors, components=64)(vectors)
    squares = F.array(*[F.col(f"pca{i + 1}") ** 2 for i in range(64)])
    return mapped.select("vec_id", F.round(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x), 5).alias("squared"))


@query("""
    WITH means AS (SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY i),
    spread AS (SELECT sum(power(CAST(embedding[i] AS DOUBLE) - m, 2)) / (SELECT count(*) FROM embeddings) AS v FROM embeddings JOIN means ON TRUE)
    SELECT i AS component, 0.0::DOUBLE AS mean, 0.0::DOUBLE AS shared, TRUE AS falling, round((SELECT v FROM spread), 5) AS total FROM (SELECT unnest(range(1, 65)) AS i)""")
def pca_components(spark, d):
    """Components have mean 0, share no variance with the one before, fall in variance, and hold all variance of the vectors together."""
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    mapped = clusters.fit_plane(vectors, components=64)(vectors)
    names = [f"pca{i + 1}" for i in range(64)]
    moments = mapped.agg(
        *[F.avg(n).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.var_pop(n).alias(f"v{i}") for i, n in enumerate(names)],
        *[F.covar_pop(names[max(i - 1, 0)], n).alias(f"c{i}") for i, n in enumerate(names)],
    )
    total = sum((F.col(f"v{i}") for i in range(1, 64)), F.col("v0"))
    rows = [
        F.struct(
            F.lit(i + 1).cast("long").alias("component"),
            F.abs(F.round(f"m{i}", 6)).alias("mean"),
            (F.abs(F.round(f"c{i}", 6)) if i else F.lit(0.0)).alias("shared"),
            (F.col(f"v{i}") <= F.col(f"v{max(i - 1, 0)}") + 1e-9).alias("falling"),
            F.round(total, 5).alias("total"),
        )
        for i in range(64)
    ]
    return moments.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("""
    SELECT label, count(*) AS points, round(avg(CAST(embedding[1] AS DOUBLE)), 6) AS pca1,
           round(avg(CAST(embedding[2] AS DOUBLE)), 6) AS pca2 FROM embeddings GROUP BY label""")
def cluster_points(spark, d):
    """On the plane of the first two coordinates."""
    at = {f"pca{i + 1}": F.col("embedding")[i].cast("double") for i in range(2)}
    points = clusters.cluster_points(table(spark, d, "embeddings").withColumns(at), "label")
    return points.select("label", "points", F.round("pca1", 6).alias("pca1"), F.round("pca2", 6).alias("pca2"))


@query()
def hash_embedding(spark, d):
    return clusters.hashed_embedding(table(spark, d, "documents")).select("doc_id", "embedding")
