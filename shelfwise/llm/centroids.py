"""Centroid clustering of integer vectors, with centroids ruled out by
n-simplex bounds.

The distances of a point to m pivots fix its place against the simplex that
the pivots span: coordinates in the simplex's own space and a height over it
(the apex). The Euclidean distance of two apexes is a lower bound of the two
points' distance, and with one apex mirrored at the base an upper bound. The
apex of every vector is computed once and written beside it; a round computes
those of the centroids, keeps for each vector the centroids whose lower bound
is not above the smallest upper bound, and compares only these in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import written

#: Components of a scaled vector stay below this, so that squared distances
#: of up to 64 components fit 64 bits.
LIMIT = 1 << 27
#: Relative slack of the bounds, far above their rounding error.
_SLACK = 1e-7


class Simplex:
    """Apex coordinates against a base of pivots (rows of integers)."""

    def __init__(self, candidates: np.ndarray, most: int):
        # Pivots that stand off the space of the earlier ones; a candidate
        # inside it would make the base flat.
        points = candidates.astype(np.float64)
        chosen, basis = [0], []
        scale = max(1.0, float(np.abs(points - points[0]).max(initial=0)))
        for i in range(1, len(points)):
            if len(chosen) == most:
                break
            rest = points[i] - points[0]
            for b in basis:
                rest = rest - (rest @ b) * b
            norm = float(np.sqrt(rest @ rest))
            if norm > 1e-3 * scale:
                chosen.append(i)
                basis.append(rest / norm)
        self.pivots = candidates[chosen].astype(np.int64)
        square = self.distances(self.pivots) ** 2
        gram = (square[0, 1:, None] + square[0, None, 1:] - square[1:, 1:]) / 2
        base = np.linalg.cholesky(gram) if len(gram) else np.zeros((0, 0))
        self.solve = np.linalg.inv(base).T if len(base) else base
        self.norms = (base ** 2).sum(1)

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Distances to the pivots, from exact squares."""
        out = np.empty((len(vectors), len(self.pivots)))
        for j, p in enumerate(self.pivots):
            diff = vectors.astype(np.int64) - p
            out[:, j] = np.einsum("ij,ij->i", diff, diff)
        return np.sqrt(out)

    def apex(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates in the base's space, and the height as the last."""
        square = self.distances(vectors) ** 2
        flat = ((square[:, :1] + self.norms - square[:, 1:]) / 2) @ self.solve
        height = np.sqrt(np.maximum(square[:, 0] - (flat ** 2).sum(1), 0))
        return np.column_stack((flat, height))


def possible(apexes: np.ndarray, centroid_apexes: np.ndarray) -> np.ndarray:
    """For each vector, which centroids the bounds leave."""
    a2, c2 = (apexes ** 2).sum(1)[:, None], (centroid_apexes ** 2).sum(1)[None, :]
    slack = _SLACK * (a2 + c2 + 1)
    lower = a2 + c2 - 2 * apexes @ centroid_apexes.T
    upper = lower + 4 * np.outer(apexes[:, -1], centroid_apexes[:, -1])
    return lower - slack <= (upper + slack).min(1, keepdims=True)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray,
            centroid_apexes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared
    distance, both exact."""
    left = possible(apexes, centroid_apexes)
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    which = np.zeros(len(vectors), dtype=np.int32)
    for j, c in enumerate(centroids):
        at = np.flatnonzero(left[:, j])
        diff = vectors[at] - c
        d = np.einsum("ij,ij->i", diff, diff)
        closer = d < best[at]
        best[at[closer]], which[at[closer]] = d[closer], j
    return which, best


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _place(simplex: Simplex, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                apex = simplex.apex(_matrix(b.column(1), dims, np.int64))
                ends = np.arange(0, apex.size + 1, apex.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(apex.ravel()))],
                    names=["id", "v", "apex"])
    return run


def _sums(simplex: Simplex, centroids: np.ndarray):
    """Per task and centroid: number of its vectors and component sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        heights = simplex.apex(centroids)
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for b in batches:
            v = _matrix(b.column(0), dims, np.int64)
            which, _ = nearest(v, _matrix(b.column(1), heights.shape[1], np.float64), centroids, heights)
            counts += np.bincount(which, minlength=k)
            for j in range(k):
                sums[j] += v[which == j].sum(0)
        for j in np.flatnonzero(counts).tolist():
            yield pa.RecordBatch.from_pydict({
                "c": pa.array(np.full(dims, j), pa.int32()), "i": pa.array(np.arange(dims), pa.int32()),
                "n": pa.array(np.full(dims, counts[j]), pa.int64()), "s": pa.array(sums[j], pa.int64())})
    return run


def _assign(simplex: Simplex, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heights = simplex.apex(centroids)
        for b in batches:
            which, d = nearest(_matrix(b.column(1), centroids.shape[1], np.int64),
                               _matrix(b.column(2), heights.shape[1], np.float64), centroids, heights)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(which, pa.int32()), pa.array(d, pa.int64())],
                                             names=["id", "cluster", "distance"])
    return run


def _kept(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    v = F.col(vec_col)
    fits = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < LIMIT - 1, F.lit(False)))  # NaN is largest
    return (vectors.where((F.size(v) == dims) & fits)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v")))


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, k: int = 16,
            rounds: int = 3, scale: int = 64, seed: int = 1, pivots: int = 7) -> DataFrame:
    """One row per kept vector: ``id_col``, ``cluster``, ``distance`` (squared,
    of the integer vectors floor(scale * x)), ``cluster_inertia``, ``inertia``
    and ``centroid`` (integers).

    The ``k`` kept vectors with the smallest sha256 of ``seed:id`` start as
    centroids; each round assigns all vectors and replaces every non-empty
    centroid by the exact floor of its vectors' mean; then all are assigned
    once more. Tasks send one sum per centroid, so a centroid with a third of
    all vectors costs no more than another, and the driver holds only the k
    centroids. Up to ``pivots`` of the first centroids span the simplex.

    Defined cases: a null vector, one of another length, and one with a null
    or non-finite component are left out, as is one whose scaled components
    pass 2**27 (its squared distances would not fit 64 bits); a null id
    hashes as an empty one; rows with one id are taken in order of their
    vectors; equal vectors may start as several centroids, of which only the
    first gets rows; with fewer than k vectors all of them are centroids; an
    empty table gives an empty result; other columns are not looked at.
    """
    spark = vectors.sparkSession
    kept = _kept(vectors, id_col, vec_col, dims, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.select("v", key.alias("key")).orderBy("key", "v").limit(k).collect()
    result = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not first:
        return spark.createDataFrame([], result)
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    simplex = Simplex(centroids, pivots)
    placed = written(kept.mapInArrow(_place(simplex, dims), "id long, v array<int>, apex array<double>"), "apexes")
    for _ in range(rounds):
        sums = (placed.select("v", "apex").mapInArrow(_sums(simplex, centroids), "c int, i int, n long, s long")
                .groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
        new = centroids.copy()
        for r in sums.collect():  # k x dims rows
            new[r["c"], r["i"]] = int(r["s"]) // r["n"]
        centroids = new
    assigned = written(placed.mapInArrow(_assign(simplex, centroids), "id long, cluster int, distance long"), "clusters")
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    total = int(sum(r["d"] for r in per))
    figures = spark.createDataFrame(
        [(r["cluster"], int(r["d"]), total, centroids[r["cluster"]].tolist()) for r in per],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return (assigned.withColumnRenamed("id", id_col).join(F.broadcast(figures), "cluster")  # k rows
            .select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid"))


def centroid_digest(centroid) -> str:
    """sha256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
