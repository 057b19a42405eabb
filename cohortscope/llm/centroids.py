"""Centroid clustering in whole numbers, each vector's nearest centroid found by the threshold algorithm.

Every dimension keeps its centroids sorted. From a vector's value the lists are walked outward in all dimensions at
once; a centroid that is met for the first time is compared exactly. The squares of the last steps add up to a
frontier: no centroid that is still unseen can be nearer. The walk ends when the frontier strictly exceeds the best
exact distance, so that equal distances are all seen and the smaller number wins.

Vectors stay in Spark. A round sends the centroids to the tasks and takes back, for each centroid, the number of its
vectors and their sums; the driver sees one row a centroid.

Vectors that are null, of another length, or hold nulls, NaN or infinite values are left out. Repeated rows count
each; a null vec_id is kept, but starts no centroid before one with an id. Other columns play no part. An empty
table gives no rows. A scaled value over MAX_VALUE stops the run: its exact squares would not fit a bigint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cohortscope.llm.shared import land

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
MAX_VALUE = 1 << 27
_ROWS = 4096
_FAR = np.int64(1) << np.int64(30)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each vector the number of the nearest centroid, its squared distance and the steps walked."""
    n, (k, dimensions) = len(vectors), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable").T
    values = np.sort(centroids, axis=0).T  # one sorted list a dimension
    # A sentinel at either end is farther than any value.
    fenced = np.hstack([np.full((dimensions, 1), -_FAR), values, np.full((dimensions, 1), _FAR)])
    right = (vectors[:, :, None] > values[None]).sum(axis=2) + 1
    left = right - 1
    dims = np.arange(dimensions)
    best = np.full(n, np.iinfo(np.int64).max)
    cluster = np.full(n, k)
    steps = np.zeros(n, dtype=np.int64)
    seen = np.zeros((n, k), dtype=bool)
    walking = np.arange(n)
    for step in range(1, k + 1):
        x, lo, hi = vectors[walking], left[walking], right[walking]
        below, above = x - fenced[dims, lo], fenced[dims, hi] - x
        down = below <= above
        met = order[dims, np.where(down, lo, hi) - 1]
        left[walking], right[walking] = np.where(down, lo - 1, lo), np.where(down, hi, hi + 1)
        frontier = (np.where(down, below, above) ** 2).sum(axis=1)
        for number in range(k):
            new = (met == number).any(axis=1) & ~seen[walking, number]
            rows = walking[new]
            seen[rows, number] = True
            distance = ((vectors[rows] - centroids[number]) ** 2).sum(axis=1)
            nearer = (distance < best[rows]) | ((distance == best[rows]) & (number < cluster[rows]))
            best[rows[nearer]], cluster[rows[nearer]] = distance[nearer], number
        steps[walking] = step
        walking = walking[frontier <= best[walking]]
        if not len(walking):
            break
    return cluster, best, steps


def whole_numbers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and the components as floor(scale * x), for vectors of `dimensions` finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where((F.size("embedding") == dimensions) & finite)
    scaled = F.transform("embedding", lambda x: x.cast("double") * scale)
    too_far = F.exists(scaled, lambda x: F.abs(x) > MAX_VALUE)
    return kept.select("vec_id", F.when(too_far, F.raise_error(F.lit(f"a scaled component exceeds {MAX_VALUE}")))
                       .otherwise(F.transform(scaled, lambda x: F.floor(x))).alias("v"))


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hash of seed and vec_id, in the order of the hash."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = kept.orderBy(hashed.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    return np.array([r["v"] for r in chosen], dtype=np.int64)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def _sums(kept: DataFrame, centroids: np.ndarray) -> list[Row]:
    """For each centroid with vectors: their number and the sum of each component."""
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros(centroids.shape, dtype=np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                vectors = _matrix(batch.column("v").slice(first, _ROWS), dimensions)
                cluster, _, _ = nearest(vectors, centroids)
                counts += np.bincount(cluster, minlength=len(centroids))
                for number in np.unique(cluster).tolist():
                    sums[number] += vectors[cluster == number].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(centroids)), pa.int32()), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])

    parts = kept.select("v").mapInArrow(run, "cluster int, n bigint, sums array<bigint>").where("n > 0")
    return parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dimensions)]).alias("sums")).collect()


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row a vector: vec_id, the nearest centroid's number, the squared distance, and the steps walked for it."""
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                cluster, distance, steps = nearest(_matrix(part.column("v"), dimensions), centroids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(steps, pa.int32())],
                    ["vec_id", "cluster", "distance", "steps"])

    return kept.select("vec_id", "v").mapInArrow(run, "vec_id bigint, cluster int, distance bigint, steps int")


def fit(kept: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """The centroids after `rounds` rounds, one row each; fewer than `clusters` if there are fewer vectors.

    A round replaces every centroid that has vectors by the floor of their mean. A round that changes nothing is the
    last that needs to run.
    """
    centroids = first_centroids(kept, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for row in _sums(kept, centroids):
            moved[row["cluster"]] = [total // row["n"] for total in row["sums"]]
        if (moved == centroids).all():
            break
        centroids = moved
    return centroids


def cluster(vectors: DataFrame, dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row a kept vector: vec_id, cluster, distance (squared), steps, the distances summed over its cluster and
    over all, and a hash of its centroid."""
    kept = land(whole_numbers(vectors, dimensions, scale), "whole_vectors")
    centroids = fit(kept, clusters, rounds, seed)
    spark = vectors.sparkSession
    if not len(centroids):
        centroids = np.zeros((1, dimensions), dtype=np.int64)  # no vectors: nothing is compared with it
    placed = land(assign(kept, centroids), "placed_vectors")
    # One row a centroid.
    totals = {r["cluster"]: r["total"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    rows = [(i, totals[i], sum(totals.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids.tolist()) if i in totals]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return placed.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "steps")
