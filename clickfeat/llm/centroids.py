"""Centroid clustering over Hilbert-ordered blocks with zone maps (operator 11).

Vectors become integers, ``floor(256 * x)``, and are put into blocks along a
Hilbert curve (hilbert.py); every block keeps the box of its vectors. A round
broadcasts the centroids (their number times their length is fixed). For each
block two bounds leave its candidate centroids:

* a centroid whose least distance to the box is above another's greatest one
  can be nearest to no vector of the block;
* against the centroid nearest to the box's middle, the difference of two
  squared distances is linear in the vector, so its extreme over the box is a
  sum over dimensions; a centroid that is further for all of the box goes.

Only the candidates are compared with the block's vectors, in whole numbers;
ties go to the smaller number. A round's sums reach the driver as one row a
centroid and dimension.

Defined cases: only vectors of exactly ``dims`` components, none NULL or
non-finite, take part (rows with a NULL id too; they start no centroid);
repeated rows count each, and among equal hashes the smaller vector starts
first; fewer vectors than centroids give as many centroids as vectors; an
empty table gives no rows. Components beyond 2 ** 27 raise an error, since their distances do
not fit a long. Only the two named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import stored
from clickfeat.llm.hilbert import blocks, checked, finite, longs, products, unpacked, whole

SCALE, CENTROIDS, ROUNDS, SEED, DIMS = 256, 40, 5, 2, 64
BLOCK_ROWS = 512
NO_ID = np.iinfo(np.int64).min     # stands for a NULL id inside the blocks


def starts(rows: DataFrame, count: int, seed: int) -> np.ndarray:
    """The first centroids: the vectors of smallest hash of seed and id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.filter(F.col("vec_id").isNotNull()).select(h.alias("h"), "q").orderBy("h", "q").limit(count).collect()
    return np.array([r["q"] for r in first], dtype=np.int64)


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The numbers of the centroids that can be nearest (or tie) to some point of the box."""
    near = np.maximum(np.maximum(lo - centroids, centroids - hi), 0)
    far = np.maximum(np.abs(centroids - lo), np.abs(hi - centroids))
    least, most = (near * near).sum(1), (far * far).sum(1)
    left = np.flatnonzero(least <= most.min())
    middle = 2 * centroids[left] - (lo + hi)
    pivot = centroids[left[(middle * middle).sum(1).argmin()]]
    # |x - pivot|^2 - |x - c|^2 = 2 x (c - pivot) + |pivot|^2 - |c|^2, at its greatest over the box.
    step = centroids[left] - pivot
    most = 2 * np.where(step > 0, step * hi, step * lo).sum(1) + (pivot * pivot).sum() - (centroids[left] ** 2).sum(1)
    return left[most >= 0]


def nearest(vals: np.ndarray, centroids: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid among ``numbers`` (ascending)."""
    some = centroids[numbers]
    dist = (vals * vals).sum(1)[:, None] - 2 * products(vals, some) + (some * some).sum(1)[None, :]
    at = dist.argmin(1)
    return numbers[at], dist[np.arange(len(vals)), at]


def _assigned(shipped, dims: int):
    """Per block: ids, values, numbers, distances (inside a task)."""
    def each(batches: Iterator[pa.RecordBatch]):
        centroids = shipped.value
        for b in batches:
            lo, hi = b.column("lo").to_pylist(), b.column("hi").to_pylist()
            for k, (ids, vals) in enumerate(zip(b.column("vec_id").to_pylist(), b.column("vals").to_pylist(), strict=True)):
                i = longs(ids)
                v = unpacked(vals, len(i), dims)
                yield (i, v, *nearest(v, centroids, candidates(np.array(lo[k]), np.array(hi[k]), centroids)))
    return each


def updated(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of their vectors' means."""
    spark = table.sparkSession
    count, dims = centroids.shape
    shipped = spark.sparkContext.broadcast(centroids)
    each = _assigned(shipped, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for _, vals, number, _ in each(batches):
            for c in np.unique(number).tolist():
                own = number == c
                sums[c] += vals[own].sum(0)
                sizes[c] += int(own.sum())
        full = np.flatnonzero(sizes)
        at = np.repeat(full, dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(full))),
             pa.array(sums[full].ravel()), pa.array(sizes[at])], ["c", "d", "s", "n"])

    rows = table.select("vec_id", "vals", "lo", "hi").mapInArrow(run, "c int, d int, s long, n long") \
        .groupBy("c", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    shipped.destroy()
    out = centroids.copy()
    for r in rows:                       # a row a centroid and dimension
        out[r["c"], r["d"]] = int(r["s"]) // r["n"]
    return out


def clustered(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS,
              scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every kept vector (a stored table), and the final centroids."""
    kept = vectors.filter((F.size(vector) == dims) & finite(vector)) \
        .select(F.col(key).cast("long").alias("vec_id"), F.lit(dims).alias("dim"), whole(vector, scale).alias("q"))
    kept = stored(checked(kept), "centroid-vectors")
    centroids = starts(kept, count, seed).reshape(-1, dims)
    if not len(centroids):
        return kept.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    table = blocks(kept.withColumn("vec_id", F.coalesce("vec_id", F.lit(int(NO_ID)))), "centroid-blocks", BLOCK_ROWS, ("vec_id",))
    for _ in range(rounds):
        centroids = updated(table, centroids)
    shipped = vectors.sparkSession.sparkContext.broadcast(centroids)
    each = _assigned(shipped, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, number, dist in each(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NO_ID), pa.array(number.astype(np.int32)), pa.array(dist)],
                                             ["vec_id", "cluster", "distance"])

    found = table.select("vec_id", "vals", "lo", "hi").mapInArrow(run, "vec_id long, cluster int, distance long")
    return stored(found, "centroid-clusters"), centroids


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """``clustered`` with each cluster's and the whole inertia and the final centroid's hash."""
    found, centroids = clustered(vectors, **options)
    sums = {r["cluster"]: int(r["s"]) for r in
            found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One short row a centroid.
    facts = found.sparkSession.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), h) for c, h in enumerate(hashes)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
