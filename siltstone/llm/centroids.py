"""Centroid clustering in exact integers, with centroids passed over by n-simplex projection.

A few pivots span a simplex. The distances of a vector to them fix the apex that
it would be over that base: coordinates within the base, and an altitude above
it. Between two apexes the Euclidean distance is a lower bound of the distance of
the vectors, and the distance with one altitude mirrored is an upper bound. The
distances to the pivots are measured once and kept as apexes; each round then
compares apexes, passes over centroids that can't be nearest, and works out
integer distances for the rest.

Results are exact: bounds only tell what needn't be compared. All sums are whole
numbers, and only sums leave a task, at most one row for a cluster and component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import bounded_batches, ints, materialise, release

#: A pivot must rise above the base of those before it by this part of the longest distance; others are left out.
LEAST_ALTITUDE = 1e-3
#: Room for rounding in bounds, as a part of the squared lengths. Far above what doubles lose, far below what prunes.
ROUNDING = 1e-7
#: Rows that a task adds up before it hands on its sums.
FLUSH_ROWS = 1 << 28


def finite(vector: str) -> Column:
    """Vectors that are not null and hold only finite numbers."""
    v = F.col(vector)
    return v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def checked(x: np.ndarray) -> np.ndarray:
    """Whole vectors, if squared distances and inner products have room in 64 bits: for 64 components, all below 2 ** 27."""
    most = math.isqrt(2**62 // max(1, x.shape[1])) >> 1
    if x.size and max(int(x.max()), -int(x.min())) >= most:
        raise OverflowError(f"a scaled component is not below {most}; its products have no room in 64 bits")
    return x


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    bounds = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(bounds), pa.py_buffer(rows.tobytes())])


def _rows(column: pa.Array, kind: type, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(x.as_buffer() for x in column), kind).reshape(len(column), width)


class Simplex:
    """The base spanned by pivots, worked out from their distances alone."""

    def __init__(self, pivots: np.ndarray):
        kept, base = [0], np.zeros((0, 0))
        apart = self._squares(pivots, pivots)
        least = LEAST_ALTITUDE**2 * apart.max(initial=0)
        for i in range(1, len(pivots)):
            j = kept[1:]
            inner = (apart[0, i] + apart[0, j] - apart[i, j]) / 2
            y = np.linalg.solve(base, inner) if j else inner
            altitude = apart[0, i] - y @ y
            if altitude > least:
                base = np.block([[base, np.zeros((len(j), 1))], [y[None, :], np.array([[np.sqrt(altitude)]])]])
                kept.append(i)
        self.pivots, self.inverse, self.from_first = pivots[kept], np.linalg.inv(base), apart[0, kept[1:]]
        self.size = len(kept)

    @staticmethod
    def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Squared distances of whole numbers, exact but for the last rounding."""
        out = np.empty((len(x), len(y)))
        for j, other in enumerate(y):
            apart = x - other
            out[:, j] = np.einsum("ij,ij->i", apart, apart)
        return out

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Coordinates within the base, then the altitude, from the distances to the pivots."""
        far = self._squares(x, self.pivots)
        y = (far[:, :1] + self.from_first - far[:, 1:]) / 2 @ self.inverse.T
        altitude = np.sqrt(np.maximum(0.0, far[:, 0] - np.einsum("ij,ij->i", y, y)))
        return np.column_stack([y, altitude])


class Nearest:
    """The nearest centroid of each vector, ties to the smaller number."""

    def __init__(self, simplex: Simplex, centroids: np.ndarray):
        self.centroids, self.apexes = centroids, simplex.apexes(centroids)
        self.compared = 0

    def candidates(self, apexes: np.ndarray) -> np.ndarray:
        """Whether each centroid may be nearest, by the bounds."""
        low, high = np.empty((len(apexes), len(self.centroids))), np.empty((len(apexes), len(self.centroids)))
        lengths = np.einsum("ij,ij->i", apexes, apexes)
        for j, apex in enumerate(self.apexes):
            apart = apexes[:, :-1] - apex[:-1]
            base = np.einsum("ij,ij->i", apart, apart)
            room = ROUNDING * (lengths + apex @ apex + 1)
            low[:, j] = base + (apexes[:, -1] - apex[-1]) ** 2 - room
            high[:, j] = base + (apexes[:, -1] + apex[-1]) ** 2 + room
        return low <= high.min(axis=1, keepdims=True)

    def distances(self, vectors: np.ndarray, j: int) -> np.ndarray:
        self.compared += len(vectors)
        apart = vectors - self.centroids[j]
        return np.einsum("ij,ij->i", apart, apart)

    def __call__(self, vectors: np.ndarray, apexes: np.ndarray) -> np.ndarray:
        may = self.candidates(apexes)
        open_ = may.sum(axis=1) > 1
        far = np.full(may.shape, np.iinfo(np.int64).max)
        far[may] -= 1  # a lone candidate needs no distance
        for j in range(may.shape[1]):
            who = np.flatnonzero(may[:, j] & open_)
            far[who, j] = self.distances(vectors[who], j)
        return far.argmin(axis=1)


def _first_rows(rows: DataFrame, seed: str, many: int) -> np.ndarray:
    """The rows with the smallest hashes of their id, in order of hashes; ties by components, a null id last."""
    by = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    found = rows.select(by.alias("by"), "v").orderBy(F.asc_nulls_last("by"), "v").limit(many).collect()
    return np.array([r.v for r in found])


def _pivots(first: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """The first centroids and where they move on a sample. Any pivots give the same clusters."""
    out, centroids = [first], first
    for _ in range(3):
        own = Simplex._squares(sample, centroids).argmin(axis=1) if len(sample) else sample
        centroids = np.array([sample[own == j].sum(axis=0) // np.sum(own == j) if np.any(own == j) else c for j, c in enumerate(centroids)])
        out.append(centroids)
    return np.concatenate([out[0], out[1], out[3]])


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, scale: int = 1024, width: int = 64, seed: str = "3:",
            sample: int = 4096, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    Vectors of another length than `width`, null ones and those with a null or
    non-finite component are left out. Repeated rows count each and come back
    each; rows with a null key are kept and start no centroid while others can.
    Fewer vectors than clusters make as many clusters as vectors. An empty table
    gives no rows. Components too large for 64-bit distances raise an error (see `checked`). `sample`
    bounds the vectors that choose pivots, which sets the speed alone.
    """
    spark = vectors.sparkSession
    kept = vectors.where(finite(vector) & (F.size(vector) == width)).select(
        F.col(key).alias("id"), F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale)).alias("v")
    )
    first = _first_rows(kept, seed, clusters + sample)
    kind = kept.schema["id"].dataType.simpleString()
    if not len(first):
        return spark.createDataFrame([], f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = checked(first)[:clusters]
    simplex = Simplex(_pivots(centroids, first[clusters:]))
    bounded_batches(spark)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            v = checked(matrix(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(v.astype("<i4")), _binary(simplex.apexes(v))], ["id", "v", "apex"])

    table = materialise(kept.mapInArrow(project, f"id {kind}, v binary, apex binary"), "apexes")

    def add_up(nearest: Nearest):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(nearest.centroids)
            sums, counts = np.zeros((k, width + 1), np.int64), 0

            def out() -> pa.RecordBatch:
                at = np.indices(sums.shape).reshape(2, -1)
                return pa.RecordBatch.from_pydict({"cluster": ints(at[0]), "place": ints(at[1]), "total": ints(sums.ravel())})

            for batch in batches:
                v = _rows(batch.column(0), "<i4", width).astype(np.int64)
                own = nearest(v, _rows(batch.column(1), "<f8", simplex.size))
                for j in range(k):
                    sums[j, :width] += v[own == j].sum(axis=0)
                    sums[j, width] += int((own == j).sum())
                counts += len(v)
                if counts >= FLUSH_ROWS:
                    yield out()
                    sums[:], counts = 0, 0
            if counts:
                yield out()

        return run

    for _ in range(rounds):
        parts = table.select("v", "apex").mapInArrow(add_up(Nearest(simplex, centroids)), "cluster long, place long, total long")
        totals = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        sums = [[0] * (width + 1) for _ in centroids]
        for r in totals.collect():  # clusters times (components + 1) rows
            sums[r.cluster][r.place] = int(r.total)
        centroids = np.array([[s // own[-1] for s in own[:-1]] if own[-1] else c.tolist() for own, c in zip(sums, centroids)])

    last = Nearest(simplex, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _rows(batch.column(1), "<i4", width).astype(np.int64)
            own = last(v, _rows(batch.column(2), "<f8", simplex.size))
            apart = v - last.centroids[own]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32)), pa.array(np.einsum("ij,ij->i", apart, apart))], ["id", "cluster", "distance"])

    assigned = materialise(table.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned")
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*(F.lit(x).cast(kind) for x in values)), F.col("cluster") + 1)

    own = of_cluster([inertia.get(j, 0) for j in range(len(centroids))], "long")
    return assigned.select(
        F.col("id").alias(key), "cluster", "distance", own.alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(names, "string").alias("centroid_sha256"),
    )
