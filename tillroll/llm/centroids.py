"""Centroid clustering with bounds that drift by geometry.

Lloyd's rounds over integer vectors, all assignments exact. Each vector carries a
lower bound of its distance to every centroid but its own. When the centroids
move, the bound must fall by the largest d(x, c) - d(x, c') that a vector of its
cluster can see. The full drift |c - c'| is one bound of that; a smaller one comes
from the plane through the old centroid, the new one and the centre of the
cluster's sphere. There the points with d(x, c) - d(x, c') >= 2a lie within a branch
of a hyperbola, which lies within its asymptotes, a wedge about the direction of
the move with its tip half way. If the sphere, seen from that tip, comes no nearer
to the direction than the angle t, then no vector in it loses more than
|c - c'| * cos t, and none at all from a right angle on.

A vector whose exact distance to its own centroid stays below its bound keeps its
cluster; the others, the ambiguous ones, are compared with all centroids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.scratch import delete, folder, ready

CLUSTERS, ROUNDS, DIMENSIONS, SEED, SCALE = 40, 5, 64, 2, 256
#: components beyond +-2^27 could make a squared distance of 64 of them exceed a long
_MOST = float(1 << 27)
#: up to here products and sums of 64 components are exact as doubles
_EXACT = 1 << 22
_SLACK = 1e-9


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, dimensions: int, scale: int) -> DataFrame:
    """vec_id and ``_v``, the components as integers floor(scale * x)."""
    def usable(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) * scale < F.lit(_MOST), F.lit(False))

    e = vectors[embedding]
    kept = vectors.where((F.size(e) == dimensions) & F.forall(e, usable))
    return kept.select(vectors[vec_id].alias("vec_id"),
                       F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("_v"))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (int64) of all rows of ``x`` to all of ``c``."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= _EXACT:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x.astype(np.int64) - row) ** 2).sum(1) for row in c], axis=1)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), squared distance, and a lower bound
    of the distance to every other centroid."""
    d = squared(x, c)
    best, rows = d.argmin(axis=1), np.arange(len(x))
    own = d[rows, best]
    if len(c) == 1:
        return best, own, np.full(len(x), np.inf)
    d[rows, best] = np.iinfo(np.int64).max
    return best, own, np.sqrt(d.min(axis=1).astype(np.float64)) * (1 - _SLACK)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, by how much the bound of its vectors falls at most: the
    largest over the other centroids. ``radius`` is that of a sphere about the old
    centroid that holds the cluster's vectors."""
    a, b = old.astype(np.float64), new.astype(np.float64)
    move = b - a
    drift = np.sqrt((move**2).sum(1))
    tip = (a + b) / 2
    to = a[:, None, :] - tip[None, :, :]  # from the tip of centroid j's wedge to the sphere of cluster i
    far = np.sqrt((to**2).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        centre = np.arccos(np.clip((to * move[None]).sum(2) / (far * drift[None]), -1, 1))
        angle = centre - np.arcsin(np.clip(radius[:, None] / far, 0, 1))
    inside = ~(far > radius[:, None]) | ~(angle > 0)
    falls = np.where(inside, drift[None], drift[None] * np.maximum(0, np.cos(np.where(inside, 0, angle))))
    falls = np.where(drift[None] > 0, falls * (1 + _SLACK) + _SLACK, 0.0)
    np.fill_diagonal(falls, 0)
    return falls.max(axis=1)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _assign(state: DataFrame, centroids: np.ndarray, loosen: np.ndarray | None) -> DataFrame:
    """A round's assignment; ``loosen`` is None for the first, which compares all."""
    dimensions = centroids.shape[1]
    schema = T.StructType([
        T.StructField("vec_id", state.schema["vec_id"].dataType), T.StructField("_v", T.ArrayType(T.IntegerType())),
        T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
        T.StructField("_bound", T.DoubleType()), T.StructField("scans", T.IntegerType()),
    ])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("_v"), dimensions)
            if loosen is None:
                cluster, own, bound = nearest(x, centroids)
                scans = np.ones(len(x), np.int32)
            else:
                cluster, bound, scans = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "_bound", "scans"))
                own = ((x.astype(np.int64) - centroids[cluster]) ** 2).sum(1)
                bound -= loosen[cluster]
                open_ = ~(np.sqrt(own.astype(np.float64)) * (1 + _SLACK) < bound)
                if open_.any():
                    cluster[open_], own[open_], bound[open_] = nearest(x[open_], centroids)
                scans += open_
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("_v"), pa.array(cluster.astype(np.int32)), pa.array(own),
                 pa.array(bound), pa.array(scans.astype(np.int32))], names=schema.names)

    return state.mapInArrow(run, schema)


def _summary(state: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, ...]:
    """Count, component sums, largest and summed squared distance by cluster. Each task
    sums its own rows first, so k rows a task are shuffled and k x dimensions collected."""
    def run(batches):
        sums, most = np.zeros((k, dimensions + 2), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("_v"), dimensions).astype(np.int64)
                own, at = batch.column("distance").to_numpy(), batch.column("cluster").to_numpy()
                order = np.argsort(at, kind="stable")
                first = np.flatnonzero(np.diff(at[order], prepend=-1))
                one = np.column_stack([x, np.ones(len(x), np.int64), own])
                sums[at[order][first]] += np.add.reduceat(one[order], first, axis=0)
                np.maximum.at(most, at, own)
        some = np.flatnonzero(sums[:, dimensions])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(most[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "most", "sums"])

    parts = state.select("_v", "cluster", "distance").mapInArrow(run, "cluster int, most long, sums array<long>")
    rows = (
        parts.select("cluster", "most", F.posexplode("sums").alias("at", "value"))
        .groupBy("cluster", "at").agg(F.sum("value"), F.max("most")).collect()
    )
    all_, most = np.zeros((k, dimensions + 2), np.int64), np.zeros(k, np.int64)
    for c, at, value, far in rows:
        all_[c, at], most[c] = value, far
    return all_[:, dimensions], most, all_[:, dimensions + 1], all_[:, :dimensions]


def cluster(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: vec_id, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia``, ``centroid`` (its cluster's components) and ``scans`` (in how many of the
    rounds + 1 assignments it was compared with all centroids).

    Kept are vectors of ``dimensions`` components, none null or non-finite; each becomes
    floor(scale * x). A vector with a component beyond +-2^27 after that is left out, as
    its squared distances need not fit a long. The start centroids are the ``clusters``
    vectors with the smallest sha256 of ``seed:vec_id`` (ties, which only repeated ids
    give: smaller vector); with fewer vectors there are fewer clusters. A null vec_id
    counts as the empty string. Repeated rows count as often as they occur. Empty tables
    give empty results; other columns aren't read.

    Each round's state is written to the shared folder and the one before deleted: a
    lost executor costs tasks of one round, and two states exist at a time. Only the
    sums of each cluster and the start centroids come to the driver.
    """
    spark = vectors.sparkSession
    ready(spark)
    src = whole_vectors(vectors, vec_id, embedding, dimensions, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    start = src.select(order.alias("h"), "_v").orderBy("h", "_v").limit(clusters).collect()
    centroids = np.array([r["_v"] for r in start], np.int64).reshape(-1, dimensions)
    k = len(centroids)
    kind = vectors.schema[vec_id].dataType
    if not k:
        return _result(spark.createDataFrame([], T.StructType([
            T.StructField("vec_id", kind), T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()), T.StructField("scans", T.IntegerType())])), centroids, np.zeros(0, np.int64), vec_id)

    state, last, loosen = src, None, None
    for i in range(rounds + 1):
        path = folder(spark, f"clusters-{i}")
        out = _assign(state, centroids, loosen)
        out.write.parquet(path)
        state = spark.read.schema(out.schema).parquet(path)
        if last:
            delete(spark, last)
        last = path
        count, most, total, summed = _summary(state, k, dimensions)
        if i < rounds:
            moved = np.where(count[:, None] > 0, summed // np.maximum(count, 1)[:, None], centroids)
            loosen = loosening(centroids, moved, np.sqrt(most.astype(np.float64)) * (1 + _SLACK))
            centroids = moved
    return _result(state.select("vec_id", "cluster", "distance", "scans"), centroids, total, vec_id)


def _result(state: DataFrame, centroids: np.ndarray, total: np.ndarray, vec_id: str) -> DataFrame:
    rows = [(i, int(total[i]), int(total.sum()), centroids[i].tolist()) for i in range(len(centroids))]
    by_cluster = state.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    out = state.join(F.broadcast(by_cluster), "cluster")  # one row per cluster
    return out.select(F.col("vec_id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid", "scans")
