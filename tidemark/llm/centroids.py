"""Centroid clustering by the threshold algorithm.

Vectors and centroids have integer components, so distances, sums and means are exact and reruns agree
whatever the partitions. Each dimension keeps its centroids in a sorted list. For a vector every list is
walked outward from the vector's own value, nearest entry first; a centroid that a list names for the first
time has its exact distance worked out. The squared gaps of the entries that the lists would give next, the
frontier, sum up to a bound below every centroid not seen yet: the walk stops once that sum strictly exceeds
the best exact distance, so that an unseen centroid cannot even tie.

Vectors never leave the executors. A round sends one sum per cluster and dimension of each partition to an
aggregate, and ``k`` times ``dims`` sums to the driver, whatever the number of vectors: a vector that is a
third of all rows, or a cluster that holds them all, is summed where it lies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import written
from tidemark.session import small_frame

#: Components of a larger size are refused: 64 squared differences of them would not fit a long.
LARGEST = 1 << 27
#: Cells (vectors times centroids or dimensions) held at once.
CELLS = 1 << 18

Centroids = list[list[int]]


class Lists:
    """The sorted list of each dimension: values in order and the centroid each belongs to."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.owner = np.argsort(centroids, axis=0, kind="stable").T  # dims x k
        self.value = np.sort(centroids, axis=0).T
        self.k, self.dims = centroids.shape
        self._dim = np.arange(self.dims)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid (the smaller of a tie), squared distance, and distances worked out."""
        n = len(points)
        number, distance, probes = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int32)
        step = max(1, CELLS // max(self.k, self.dims))
        for begin in range(0, n, step):
            part = slice(begin, begin + step)
            number[part], distance[part], probes[part] = self._walk(points[part])
        return number, distance, probes

    def _gaps(self, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What lies between each value and the next entries below and above it; -1 where a list has ended."""
        below = np.where(low >= 0, points - self.value[self._dim, np.maximum(low, 0)], -1)
        above = np.where(high < self.k, self.value[self._dim, np.minimum(high, self.k - 1)] - points, -1)
        return below, above

    def _walk(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(points)
        exact = np.full((n, self.k), np.iinfo(np.int64).max)
        high = np.empty((n, self.dims), np.int64)
        for d in range(self.dims):
            high[:, d] = np.searchsorted(self.value[d], points[:, d])
        low = high - 1
        active = np.arange(n)
        for _ in range(self.k):
            own = points[active]
            below, above = self._gaps(own, low, high)
            down = (above < 0) | ((below >= 0) & (below <= above))
            found = self.owner[self._dim, np.where(down, low, np.minimum(high, self.k - 1))]
            seen = np.zeros((len(active), self.k), dtype=bool)
            seen[np.arange(len(active))[:, None], found] = True
            seen &= exact[active] == np.iinfo(np.int64).max
            row, centroid = np.nonzero(seen)
            difference = own[row] - self.centroids[centroid]
            exact[active[row], centroid] = (difference * difference).sum(1)
            low, high = low - down, high + ~down
            below, above = self._gaps(own, low, high)
            ended = (below < 0) & (above < 0)  # such a list has named every centroid
            gap = np.where(below < 0, above, np.where(above < 0, below, np.minimum(below, above)))
            frontier = (gap * gap).sum(1)
            going = ~ended.any(1) & (frontier <= exact[active].min(1))
            active, low, high = active[going], low[going], high[going]
            if len(active) == 0:
                break
        number = exact.argmin(1)
        return number, exact[np.arange(n), number], (exact < np.iinfo(np.int64).max).sum(1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, dims)


def _sums(centroids: Centroids):
    """A pass that gives the sum of each cluster and dimension of a partition, and its number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(np.array(centroids, np.int64))
        total = np.zeros((lists.k, lists.dims), np.int64)
        count = np.zeros(lists.k, np.int64)
        for batch in batches:
            points = _matrix(batch.column("point"), lists.dims)
            number = lists.nearest(points)[0]
            order = np.argsort(number, kind="stable")
            held, begin = np.unique(number[order], return_index=True)
            if len(held):
                total[held] += np.add.reduceat(points[order], begin, axis=0)
            count += np.bincount(number, minlength=lists.k)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(held, lists.dims).astype(np.int32)),
                pa.array(np.tile(np.arange(lists.dims, dtype=np.int32), len(held))),
                pa.array(total[held].ravel()),
                pa.array(np.repeat(count[held], lists.dims)),
            ],
            names=["cluster", "dim", "total", "n"],
        )

    return run


def _assign(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(np.array(centroids, np.int64))
        for batch in batches:
            number, distance, probes = lists.nearest(_matrix(batch.column("point"), lists.dims))
            arrays = [batch.column("id"), pa.array(number), pa.array(distance), pa.array(probes)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "cluster", "distance", "probes"])

    return run


def quantised(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``(id, point)`` of the vectors with exactly ``dims`` components, all of them numbers and finite.

    A component ``x`` becomes ``floor(scale * x)``, ``x`` as double. One that is then larger than ``LARGEST``
    fails the query, since distances would not fit a long.
    """
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    too_large = F.raise_error(F.lit(f"a component beyond {LARGEST}")).cast("long")

    def component(x):
        scaled = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(scaled) <= float(LARGEST), F.floor(scaled)).otherwise(too_large)

    kept = vectors.filter((F.size(vector) == dims) & finite)
    return kept.select(F.col(id_col).cast("long").alias("id"), F.transform(vector, component).alias("point"))


def _starts(points: DataFrame, k: int) -> Centroids:
    """The ``k`` points of the smallest hash of their id; of repeated ids the smaller point first, NULL ids last."""
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    first = points.withColumn("hash", hashed).orderBy(F.col("hash").asc_nulls_last(), "point").limit(k)
    return [list(row.point) for row in first.select("point").collect()]


def _moved(centroids: Centroids, points: DataFrame) -> Centroids:
    """The centroids after one round: the floored mean of each cluster; one without vectors stays."""
    sums = points.mapInArrow(_sums(centroids), "cluster int, dim int, total long, n long")
    wide = F.sum(F.col("total").cast("decimal(38,0)"))
    found = sums.groupBy("cluster", "dim").agg(wide.alias("total"), F.sum("n").alias("n")).collect()
    moved = [list(c) for c in centroids]
    for row in found:
        moved[row.cluster][row.dim] = int(row.total) // row.n
    return moved


def clustered(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
) -> tuple[DataFrame, Centroids]:
    """``(id, cluster, distance, probes)`` of each kept vector as a written table, and the final centroids.

    Centroids start as the ``k`` kept vectors whose ids have the smallest sha256 of ``1:<id>``; with fewer
    vectors there are fewer centroids. Each round moves them to the floored mean of the vectors nearest to
    them; then vectors are assigned once more. ``distance`` is the squared Euclidean one, ``probes`` how many
    of the centroids had it worked out.

    * Vectors that are NULL, of another length, or hold NULL, NaN or an infinite value are left out.
    * Repeated rows count as often as they stand there; equal vectors go to the same cluster.
    * NULL ids are kept; their vectors are the last to become starting centroids. Ids are integers.
    * An empty frame gives an empty table and no centroids. Other columns are not read.
    """
    points = written(quantised(vectors, id_col, vector_col, dims, scale), "points")
    centroids = _starts(points, k)
    if not centroids:
        none = T.StructType.fromDDL("id long, cluster int, distance long, probes int")
        return small_frame(vectors.sparkSession, [], none), []
    for _ in range(rounds):
        centroids = _moved(centroids, points)
    assigned = points.mapInArrow(_assign(centroids), "id long, cluster int, distance long, probes int")
    return written(assigned, "assigned"), centroids


def summarised(assigned: DataFrame, centroids: Centroids) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``: at most ``k`` rows are joined."""
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    whole = sum(int(row.inertia) for row in sums)
    rows = [
        (row.cluster, int(row.inertia), whole, hashlib.sha256(",".join(map(str, centroids[row.cluster])).encode()).hexdigest())
        for row in sums
    ]
    schema = T.StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(small_frame(spark, rows, schema)), "cluster")
