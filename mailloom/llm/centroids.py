"""Centroid clustering with equal-average equal-variance nearest-neighbour search.

Vectors become integers, so every distance, sum and centroid is exact and results do not depend on the partitioning.

A vector's nearest centroid is found without comparing it with all of them. With k components, S the component sum and
V = k * sum of squares - S^2 (k^2 times the variance), for a vector x and a centroid c

    k * |x - c|^2 >= (Sx - Sc)^2 + (sqrt(Vx) - sqrt(Vc))^2.

Centroids are sorted by S. From the place of a vector's own sum the scan goes outward, always to the nearer side; it
ends at the first centroid whose sum alone is too far (the mean inequality), skips those whose deviation is too far as
well, and only the rest are compared component by component, in integers. Bounds are relaxed by more than the error of
a double, so a centroid that could tie is always compared; ties go to the smaller number.

Work on Spark: each round is one scan of the vectors with the centroids (a few KB, `clusters` times `size` integers) in
the task's code. A task returns the sums of its vectors once per cluster, not per vector; they are added up by cluster
and component. Only `clusters` times `size` totals reach the driver. The last assignment is stored, as narrow rows.

Defined cases: vectors of another length, with a null or a non-finite component, and null vectors are left out;
components are limited to +-2^27 after scaling, so that a squared distance stays a long; sums beyond a long are cut to
the largest long. A null vec_id hashes as an empty one; equal hashes (repeated ids) start in the order of their components.
With fewer vectors than clusters there are fewer clusters; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailloom.llm.common import stored

SIZE, CLUSTERS, ROUNDS, SCALE, SALT = 64, 16, 3, 64, "1:"
#: Limit of a scaled component, and vectors a task works on at once.
LIMIT, ROWS = 1 << 27, 8192


def integral(vectors: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and integer components of the vectors that are kept."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == size)
    if not len(at):
        return at, np.zeros((0, size), np.int64)
    flat = vectors.take(pa.array(at)).flatten()  # nulls become NaN, which goes with the non-finite
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    kept = np.isfinite(values).all(1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(values[kept] * scale), -LIMIT, LIMIT)
    return at[kept], scaled.astype(np.int64)


class Nearest:
    """Searches of the nearest of a few centroids (rows of integers)."""

    def __init__(self, centroids: np.ndarray) -> None:
        sums = centroids.sum(1)
        self.order = np.argsort(sums, kind="stable")  # by component mean
        self.centroids = centroids[self.order]
        self.sums = sums[self.order]
        self.deviations = self._deviation(self.centroids, self.sums)
        self.compared = 0

    @staticmethod
    def _deviation(rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """sqrt(k * sum of squares - S^2), from components less their rounded mean, which keeps the integers small."""
        k = rows.shape[1]
        near = rows - (sums // k)[:, None]
        rest = near.sum(1).astype(np.float64)
        squares = (near.astype(np.float64) ** 2).sum(1)
        return np.sqrt(np.maximum(k * squares - rest**2, 0))

    def __call__(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each row's nearest centroid, and the squared distance."""
        n, k = rows.shape
        many = len(self.sums)
        sums = rows.sum(1)
        deviations = self._deviation(rows, sums)
        high = np.searchsorted(self.sums, sums)  # next centroid above; `low` is the next below
        low = high - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, many)
        active = np.arange(n)
        for _ in range(many):
            a, b = low[active], high[active]
            below = np.where(a >= 0, sums[active] - self.sums[np.maximum(a, 0)], np.iinfo(np.int64).max)
            above = np.where(b < many, self.sums[np.minimum(b, many - 1)] - sums[active], np.iinfo(np.int64).max)
            down = below <= above
            far = np.minimum(below, above).astype(np.float64)
            place = np.where(down, a, b)
            low[active] -= down
            high[active] += ~down
            limit = best[active].astype(np.float64) * k
            by_mean = far * far
            near = by_mean * (1 - 1e-9) <= limit  # the mean inequality: all centroids further out are worse
            active, place, by_mean, limit = active[near], place[near], by_mean[near], limit[near]
            if not len(active):
                break
            spread = deviations[active] - self.deviations[place]
            bound = by_mean + spread * spread
            slack = 1e-9 * (bound + deviations[active] ** 2 + self.deviations[place] ** 2)
            maybe = bound - slack <= limit  # the deviation inequality
            chosen, against = active[maybe], place[maybe]
            self.compared += len(chosen)
            apart = rows[chosen] - self.centroids[against]
            exact = np.einsum("ij,ij->i", apart, apart)
            name = self.order[against]
            better = (exact < best[chosen]) | ((exact == best[chosen]) & (name < number[chosen]))
            best[chosen[better]], number[chosen[better]] = exact[better], name[better]
        return number, best


def _scan(vectors: DataFrame, centroids: np.ndarray, size: int, scale: int, schema: str, each) -> DataFrame:
    """Apply `each` to blocks of (batch, row numbers, integer rows, cluster, distance); its `close` ends the task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest, work = Nearest(centroids), each()
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                at, rows = integral(part.column("vector"), size, scale)
                if len(at):
                    yield from work.block(part, at, rows, *nearest(rows))
        yield from work.close()

    return vectors.mapInArrow(task, schema)


def _sums(clusters: int, size: int):
    class Work:
        def __init__(self) -> None:
            self.total = np.zeros((clusters, size + 1), np.int64)

        def block(self, part, at, rows, cluster, distance):
            order = np.argsort(cluster, kind="stable")
            heads = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            found = cluster[order][heads]
            self.total[found, 0] += np.diff(np.append(heads, len(order)))
            self.total[found, 1:] += np.add.reduceat(rows[order], heads, axis=0)
            return ()

        def close(self):
            seen = np.flatnonzero(self.total[:, 0])
            columns = [pa.array(seen, pa.int32()), pa.array(list(self.total[seen]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "totals"])

    return Work


def _rows():
    class Work:
        def block(self, part, at, rows, cluster, distance):
            columns = [part.column("vec_id").take(pa.array(at)), pa.array(cluster, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

        def close(self):
            return ()

    return Work()


def starts(vectors: DataFrame, clusters: int, size: int, scale: int, salt: str) -> np.ndarray:
    """The kept vectors with the smallest hashes of salt and id, in that order."""
    kept = vectors.where(f"size(vector) = {size} AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    scaled = F.transform("vector", lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LIMIT)), F.lit(-LIMIT)))
    first = kept.select(hashed.alias("hash"), scaled.alias("start")).orderBy("hash", "start").limit(clusters).collect()
    return np.array([r["start"] for r in first], np.int64).reshape(-1, size)


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """Each centroid replaced by the exact floor of its vectors' mean; those without vectors stay."""
    clusters, size = centroids.shape
    partial = _scan(vectors, centroids, size, scale, "cluster int, totals array<long>", _sums(clusters, size))
    added = partial.select("cluster", F.posexplode("totals")).groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total"))
    total = {(r["cluster"], r["pos"]): int(r["total"]) for r in added.collect()}  # clusters * (size + 1) rows at most
    out = centroids.copy()
    for c in range(clusters):
        if count := total.get((c, 0), 0):
            out[c] = [total[c, k + 1] // count for k in range(size)]
    return out


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
    salt: str = SALT, vec: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, the inertia of the cluster and of all, and the cluster's final centroid with its digest."""
    spark = embeddings.sparkSession
    vectors = embeddings.select(F.col(vec).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    centroids = starts(vectors, clusters, size, scale, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids, scale)
    schema = "vec_id long, cluster int, distance long"
    if len(centroids):
        assigned = stored(_scan(vectors, centroids, size, scale, schema, _rows), "centroids")
    else:
        assigned = spark.createDataFrame([], schema)
    within = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    most = (1 << 63) - 1
    rows = [(c, min(t, most), min(sum(within.values()), most), centroids[c].tolist(), digest(centroids[c])) for c, t in sorted(within.items())]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
