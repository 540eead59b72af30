"""Centroid clustering (Lloyd's rounds) by equal-average equal-variance search, in integers.

Every component x becomes floor(``scale`` * x). Centroids are sorted by their mean. For a
vector the search starts at its own mean and walks outward, always to the nearer of the two
next centroids. With k components, sums S and deviations T (T^2 = k * sum of squares - S^2),
k times the squared distance of two vectors is at least (S1 - S2)^2 + (T1 - T2)^2. So a walk
ends as soon as the first term alone exceeds k times the best distance so far (all
centroids further out have a larger one), a centroid is rejected if both together do, and
only the others get their exact integer distance. The deviation is a floating-point root, so
it rejects with a margin; sums and distances are integers, and ties go to the smaller number.

Scale. A round is one scan of the vectors: each task assigns its vectors and returns one row
of counts and sums for each cluster; Spark adds these, and the driver gets K rows for K
centroids, which it sends back with the next scan. Memory is one Arrow batch and the K sums.
Nothing is shuffled but the partial sums, so hot clusters make no hot task.

Defined cases: vectors that are null, of another length, or hold a null or non-finite
component take no part and are not returned. Neither are vectors with a component of
``LARGEST`` or more after scaling, whose distances would not fit a long. Repeated rows and
ids are vectors of their own; a vector without an id is assigned, but never a start. Of
start candidates that tie, the one with the smaller components goes first. Fewer than K
starts give fewer centroids; without any there is no cluster and no row. Extra columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow.llm.shared import arrow_stage, ship, written

CENTROIDS = 16
COMPONENTS = 64
ROUNDS = 3
SCALE = 64
LARGEST = 1 << 26


def kept_vectors(df: DataFrame, id_name: str, vector: str, size: int = COMPONENTS,
                 scale: int = SCALE) -> DataFrame:
    """vec_id and v (array of long) of the vectors that take part."""
    raw = df.select(F.col(id_name).cast("long").alias("vec_id"), F.transform(
        vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        F.col(vector).alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double") * scale) < LARGEST))
    return raw.filter((F.size("x") == size) & fine).select("vec_id", "v")


def starts(vectors: DataFrame, count: int, seed: int = 1) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:id``, in the order of the hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.filter("vec_id is not null").select(order.alias("h"), "v").orderBy(
        "h", "v").limit(count).collect()  # at most ``count`` rows
    return np.array([r["v"] for r in first], dtype=np.int64)


class Search:
    """The centroids, sorted by mean (that is by sum, as all have k components)."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.c, self.k = centroids[self.number], centroids.shape[1]
        self.sums = sums[self.number]
        self.spread = self._spread(self.c, self.sums)

    def _spread(self, x: np.ndarray, sums: np.ndarray) -> np.ndarray:
        apart = (self.k * x - sums[:, None]).astype(float)  # no cancellation in the squares
        return np.sqrt(np.einsum("ij,ij->i", apart, apart) / self.k)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance) of each vector, and how many exact distances it
        took."""
        n, exact = len(x), 0
        sums = x.sum(axis=1)
        spread = self._spread(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        cluster = np.full(n, len(self.c), dtype=np.int64)
        row = np.arange(n)
        while len(row):
            s, lo, hi = sums[row], left[row], right[row]
            # the nearer of the next centroid below and the next above the vector's mean
            down = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], np.inf)
            up = np.where(hi < len(self.c), self.sums[np.minimum(hi, len(self.c) - 1)] - s,
                          np.inf)
            step_down = down <= up
            gap = np.where(step_down, down, up)
            budget = best[row].astype(float) * self.k
            budget *= 1 + 1e-9  # as the products are rounded
            go = (gap * gap <= budget) & (gap < np.inf)
            row, step_down, gap, budget = row[go], step_down[go], gap[go], budget[go]
            at = np.where(step_down, left[row], right[row])
            left[row[step_down]] -= 1
            right[row[~step_down]] += 1
            a, b = spread[row], self.spread[at]
            d = np.maximum(np.abs(a - b) - 1e-12 * (a + b), 0.0)  # as the roots are rounded
            near = gap * gap + d * d <= budget
            r, at = row[near], at[near]
            diff = x[r] - self.c[at]
            exact += len(r)
            got, number = np.einsum("ij,ij->i", diff, diff), self.number[at]
            better = (got < best[r]) | ((got == best[r]) & (number < cluster[r]))
            best[r[better]], cluster[r[better]] = got[better], number[better]
        return cluster, best, exact


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list:
    """(cluster, count, sums) of all vectors at the given centroids: one row a cluster."""
    size, k = centroids.shape
    ship(vectors.sparkSession)

    def run(batches):
        search = Search(centroids)
        count, total = np.zeros(size, np.int64), [[0] * k for _ in range(size)]
        for batch in batches:
            x = _matrix(batch.column(0), k)
            cluster, *_ = search.nearest(x)
            for c in np.unique(cluster).tolist():
                own = x[cluster == c]
                count[c] += len(own)
                total[c] = [a + b for a, b in zip(total[c], own.sum(axis=0).tolist())]
        some = np.flatnonzero(count).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]),
             pa.array([total[c] for c in some], pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n long, sums array<long>")
    # decimals: the sum over all tasks may pass 64 bits
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[
        F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(k)]).collect()


def moved(centroids: np.ndarray, rows: list) -> np.ndarray:
    """The centroids after a round: floor(sum / count), empty clusters as they were."""
    out = centroids.copy()
    for r in rows:
        out[r["cluster"]] = [int(r[f"s{j}"]) // int(r["n"]) for j in range(centroids.shape[1])]
    return out


def fit(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS,
        seed: int = 1) -> np.ndarray:
    """Centroids after ``rounds`` rounds over ``vectors`` (vec_id, v)."""
    centroids = starts(vectors, count, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids, _sums(vectors, centroids))
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance (squared) of each vector."""
    k = centroids.shape[1]

    def stage(batch: pa.RecordBatch):
        cluster, distance, _ = Search(centroids).nearest(_matrix(batch.column(1), k))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
            names=["vec_id", "cluster", "distance"])

    return arrow_stage(vectors, stage, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS,
              seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia (sums of distances over the
    cluster and over all) and centroid_sha256 (of the components, joined by commas)."""
    spark = vectors.sparkSession
    centroids = fit(vectors, count, rounds, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
            "centroid_sha256 string")
    found = written(assign(vectors, centroids), "clusters")
    per = found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # K rows
    whole = sum(r["s"] for r in per)
    facts = [(r["cluster"], r["s"], whole, hashlib.sha256(
        ",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in per]
    side = spark.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(side), "cluster").select(  # K rows of constants
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
