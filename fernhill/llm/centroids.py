"""Centroid clustering filtered by n-simplex projection (Connor, Vadicamo, Rabitti).

Vectors become integers and are assigned to the nearest of k centroids by exact squared
Euclidean distance, in rounds. A few of the first centroids serve as pivots, whose distances among one
another span a simplex. A vector's distances to the pivots are taken once and kept as
the apex that they put on that simplex: one coordinate for each edge from the first pivot,
and its height over the simplex's base. Of two apexes, the Euclidean distance is a lower
bound of the distance of their vectors, and with the height of one mirrored an upper
bound. So for each vector only those centroids are compared component by
component whose lower bound is not above the least upper bound of all.

Coordinates come from a Cholesky factor of the pivots' Gram matrix; pivots are taken by
the largest height over the ones before them, and dependent ones are left out, so solving is
stable, and bounds are widened by far more than rounding can amount to.

Each round is one pass over the written vectors: tasks add up their members
per cluster, at most k rows a task, and those sums are added in two steps. Only k centroids reach the driver.

Defined cases: vectors that are null, of another length, or hold null or non-finite components take no
part; a null id starts no centroid but is assigned; rows that repeat an id are rows of their own, ordered by
their components where the id's hash ties; with fewer vectors than k there are fewer centroids. Distances must
fit 64 bits, as they do for scaled components below 2^27. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Vectors that a task compares at a time.
SLICE = 4096
#: Share of the largest squared distances that bounds are widened by, and below which a pivot counts as dependent.
SLACK, DEPENDENT = 1e-9, 1e-3


@dataclass(frozen=True)
class ClusterParams:
    clusters: int = 16
    rounds: int = 3
    width: int = 64
    scale: int = 64
    pivots: int = 8
    seed: int = 1


class Simplex:
    """Base simplex of pivots (integer vectors, a line each) and apexes over it."""

    def __init__(self, choices: np.ndarray, most: int):
        picked, heights = [0] if len(choices) else [], None
        self.pivots, self.factor = choices[:1], np.zeros((0, 0))
        while 0 < len(picked) < min(most, len(choices)):
            apexes = self.apexes(choices)
            heights = apexes[:, -1] ** 2
            heights[picked] = 0
            at = int(np.argmax(heights))
            if heights[at] <= DEPENDENT * max(1.0, float((apexes ** 2).sum(axis=1).max())):
                break
            picked.append(at)
            self.pivots = choices[picked]
            edges = self.pivots[1:] - self.pivots[0]
            self.factor = np.linalg.cholesky((edges @ edges.T).astype(float))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """A line of len(pivots) coordinates per vector, the height last."""
        squares = np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)
        first = squares[:, 0].astype(float)
        if len(self.pivots) == 1:
            return np.sqrt(first)[:, None]
        edges = ((self.pivots[1:] - self.pivots[0]) ** 2).sum(axis=1)
        # by the law of cosines, the inner products with the edges follow from the distances alone
        inner = (squares[:, :1] + edges - squares[:, 1:]) / 2
        base = np.empty(inner.shape)
        for k, line in enumerate(self.factor):
            base[:, k] = (inner[:, k] - (base[:, :k] * line[:k]).sum(axis=1)) / line[k]
        return np.column_stack([base, np.sqrt(np.maximum(first - (base ** 2).sum(axis=1), 0))])


def candidates(apexes: np.ndarray, centroid_apexes: np.ndarray) -> np.ndarray:
    """Which centroids (columns) can be the nearest of each vector (line)."""
    lower = ((apexes[:, None, :] - centroid_apexes[None, :, :]) ** 2).sum(axis=2)
    upper = lower + 4 * apexes[:, -1:] * centroid_apexes[:, -1]
    slack = SLACK * ((apexes ** 2).sum(axis=1)[:, None] + (centroid_apexes ** 2).sum(axis=1).max(initial=0)) + 1e-6
    return lower - slack <= (upper + slack).min(axis=1, keepdims=True)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of, and exact squared distance to, the nearest centroid; ties go to the smaller number."""
    may = candidates(apexes, centroid_apexes)
    best, distance = np.full(len(vectors), -1, np.int32), np.full(len(vectors), np.iinfo(np.int64).max)
    for k in range(len(centroids)):
        rows = np.flatnonzero(may[:, k])
        exact = ((vectors[rows] - centroids[k]) ** 2).sum(axis=1)
        closer = (exact < distance[rows]) | (best[rows] < 0)
        best[rows[closer]], distance[rows[closer]] = k, exact[closer]
    return best, distance


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(matrix.ravel()))


def _cached(whole: DataFrame, simplex: Simplex, width: int) -> DataFrame:
    """vec_id, v, apex of all vectors, written once."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                apexes = simplex.apexes(_matrix(part.column(1), width))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _lists(apexes)], names=["vec_id", "v", "apex"])

    return settle(whole.mapInArrow(project, "vec_id bigint, v array<bigint>, apex array<double>"), "clusters-apexes")


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, simplex: Simplex):
    """(ids, vectors, cluster, distance) slice by slice."""
    width, of_centroids = centroids.shape[1], simplex.apexes(centroids)
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            vectors = _matrix(part.column(1), width)
            yield part.column(0), vectors, *nearest(vectors, _matrix(part.column(2), len(simplex.pivots)), centroids, of_centroids)


def _moved(rows: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round: exact floors of their vectors' means."""
    k, width = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for _, vectors, cluster, _ in _assigned(batches, centroids, simplex):
            np.add.at(sums, cluster, vectors)
            counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        lane = np.full(len(some), TaskContext.get().partitionId() % 64, np.int32)
        # the count travels as one more component
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(lane), _lists(np.column_stack([sums, counts])[some])], names=["cluster", "lane", "sums"])

    each = rows.mapInArrow(add, "cluster int, lane int, sums array<bigint>").select("cluster", "lane", F.posexplode("sums").alias("place", "part"))
    lanes = each.groupBy("cluster", "place", "lane").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    total = lanes.groupBy("cluster", "place").agg(F.sum("part").cast("decimal(38,0)").alias("total")).collect()  # k * (width + 1) rows
    sums = {(r.cluster, r.place): int(r.total) for r in total}
    return np.array([[sums[c, j] // sums[c, width] for j in range(width)] if (c, width) in sums else centroids[c].tolist() for c in range(k)], np.int64)


def cluster_vectors(vectors: DataFrame, params: ClusterParams = ClusterParams(), id_col: str = "vec_id",
                    vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Written rows vec_id, cluster, distance; and the final centroids, a line each."""
    spark = vectors.sparkSession
    usable = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) == params.width) & F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * params.scale).cast("long")).alias("v"))
    order = F.sha2(F.concat(F.lit(f"{params.seed}:"), F.col("vec_id").cast("string")), 256)
    starts = whole.where("vec_id IS NOT NULL").orderBy(order, "v").limit(params.clusters).collect()
    centroids = np.array([r.v for r in starts], np.int64).reshape(-1, params.width)
    if len(centroids) == 0:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    simplex = Simplex(centroids, params.pivots)
    rows = _cached(whole, simplex, params.width)
    for _ in range(params.rounds):
        centroids = _moved(rows, centroids, simplex)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _assigned(batches, centroids, simplex):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return settle(rows.mapInArrow(tell, "vec_id bigint, cluster int, distance bigint"), "clusters-assigned"), centroids


def cluster_report(vectors: DataFrame, params: ClusterParams = ClusterParams(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector."""
    rows, centroids = cluster_vectors(vectors, params, id_col, vector_col)
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # at most k rows
    told = [(c, int(total), sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, total in sums.items()]
    of_cluster = vectors.sparkSession.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
