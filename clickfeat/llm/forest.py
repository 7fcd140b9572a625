"""Embedding near-dedup by a random-projection tree forest (operator 4).

Each of ``TREES`` trees splits its vectors by random directions, near the
median of the projections; vectors in the middle tenth go to both sides
(spill). Split values are fitted on a bounded sample (``SAMPLE`` vectors of a
node, chosen by hash), every vector is indexed, and leaves that are still
larger than ``LEAF_MOST`` are split again in further rounds by samples of
their own, so a leaf always fits one task. Vectors are compared exactly, in
double precision, with all others of their leaves; a pair that shares several
leaves counts in the one of least code. Leaves pass on link counts and one
edge a vector, never their pairs.

Equal vectors are one vector with a weight. Groups that hold at least ``HEAVY``
of the sample do not go through the trees, which would cut them: their centres
are centroids of the sample's dense parts, and a vector linked with a centre
belongs to the nearest one. Its partners lie within twice the link's angle of
that centre (``RIM_COSINE``), so a group is compared exactly with all vectors
there, in blocks of slices dealt by hash. Vectors within ``BALL_COSINE`` of the
centre (half the link's angle) are all linked with each other without a
comparison, so tight copies cost one pass; the others of a group cost as many
comparisons as it has pairs. Links of a heavy group are therefore all found.

Recall of the trees, which hold the other vectors, is measured in the tests
against all pairs; a deeper forest (more vectors) loses a little at each split,
which more trees make up.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components link with nothing; vectors of different length do not link; a row
with a NULL id is linked and counted but never names a component; repeated
rows are vectors of their own; an empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import bounded_sample, components, grouped, stored

COSINE = 0.9
TREES = 16
LEAF, LEAF_MOST = 512, 2048
DEPTH = 10            # splits of one round
SAMPLE = 8192         # vectors a node's splits are fitted on
SPILL = 0.1           # share of a node's vectors that go to both sides
ROUNDS = 8            # rounds of splits; each divides a large leaf by up to 2**DEPTH
HEAVY = 0.01          # share of the sample that makes a heavy group
BALL_COSINE = float(np.cos(np.arccos(COSINE) / 2)) + 1e-9
RIM_COSINE = float(np.cos(np.arccos(COSINE) * 2)) - 1e-9
SLICE = 4096          # vectors of a heavy group on one side of a block
SEED = 20


def _directions(cell: int, depth: int, dim: int) -> np.ndarray:
    """The random directions of a subtree's nodes, the same wherever they are drawn."""
    return np.random.default_rng([SEED, cell & 0xFFFFFFFFFFFFFFFF]).standard_normal(((1 << depth) - 1, dim))


def _code(cell: int, leaf: np.ndarray) -> np.ndarray:
    """Codes of a subtree's leaves (64-bit mix of the cell and the leaf)."""
    h = (leaf.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(cell & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))).view(np.int64)


def fit_splits(cell: int, depth: int, sample: np.ndarray) -> np.ndarray:
    """Per node the lower and upper edge of its spill band."""
    dirs = _directions(cell, depth, sample.shape[1])
    bands = np.zeros((len(dirs), 2))
    at = [np.arange(len(sample))]
    for node in range(len(dirs)):
        own = at[node]
        p = sample[own] @ dirs[node]
        if len(own):
            bands[node] = np.quantile(p, [0.5 - SPILL / 2, 0.5 + SPILL / 2])
        low, high = bands[node]
        at += [own[p <= high], own[(p > high) | ((p >= low) & (low < high))]]
        at[node] = None
    return bands


def descend(cell: int, depth: int, bands: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vector offset, leaf code) of every leaf that each vector reaches."""
    dirs = _directions(cell, depth, vectors.shape[1])
    row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    for _ in range(depth):
        p = np.einsum("ij,ij->i", vectors[row], dirs[node])
        low, high = bands[node, 0], bands[node, 1]
        left = p <= high
        right = ~left | ((p >= low) & (low < high))
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    return row, _code(cell, node)


def _unit(column: pa.Array) -> np.ndarray:
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return v / np.sqrt((v * v).sum(1))[:, None]


def _depth(n: int) -> int:
    return min(DEPTH, max(0, int(np.ceil(np.log2(max(1, n) / LEAF)))))


def _lists(row: np.ndarray, code: np.ndarray, n: int) -> pa.Array:
    order = np.lexsort((code, row))
    ends = np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(code[order]))


def _planted(vectors: DataFrame, n: int) -> DataFrame:
    """``cid, w, v, ball, tight, rims, cells``: a vector's heavy group (else -1), whether it lies in
    the group's ball, the groups it is compared with, and its first leaves in all trees (if it has no group)."""
    sample = _unit(pa.array(bounded_sample(vectors, "cid", SAMPLE).toPandas()["v"].tolist(),
                            pa.list_(pa.float64())))
    centres = _centres(sample)
    rest = sample[_groups(sample, centres)[0] < 0]
    depth = _depth(n * len(rest) // max(1, len(sample)))
    bands = [fit_splits(t, depth, rest) for t in range(TREES)]
    shipped = vectors.sparkSession.sparkContext.broadcast((bands, centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, centres = shipped.value
        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(b.column("v"))
            ball, tight, rims = _groups(x, centres)
            free = np.flatnonzero(ball < 0)
            found = [descend(t, depth, bands[t], x[free]) for t in range(TREES)]
            row, code = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ball), pa.array(tight), _lists(*np.nonzero(rims), len(x)), _lists(free[row], code, len(x))],
                [*b.schema.names, "ball", "tight", "rims", "cells"])

    kind = dict(vectors.dtypes)["v"]
    return stored(vectors.select("cid", "w", "v").mapInArrow(
        run, f"cid long, w long, v {kind}, ball long, tight boolean, rims array<long>, cells array<long>"), "forest")


def _groups(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per vector its heavy group or -1, whether it lies in that group's ball, and the groups it is compared with.

    A pair of two groups is compared in the one of least number, so a vector
    joins no group above its own.
    """
    if not len(centres):
        return np.full(len(x), -1, np.int64), np.zeros(len(x), bool), np.zeros((len(x), 0), bool)
    near = x @ centres.T
    best = near.max(1)
    ball = np.where(best >= COSINE, near.argmax(1), -1)
    number = np.arange(len(centres))
    rims = (near >= RIM_COSINE) & ((ball[:, None] < 0) | (number <= ball[:, None]))
    return ball, best >= BALL_COSINE, rims


def _centres(sample: np.ndarray) -> np.ndarray:
    """Centres of the groups that hold a heavy share of the sample (at most 1 / HEAVY)."""
    least, free, out = max(8, int(HEAVY * len(sample))), np.ones(len(sample), bool), []
    if len(sample) < 64:
        return np.zeros((0, sample.shape[1]))
    degree = np.zeros(len(sample), np.int64)
    for at in range(0, len(sample), 1024):
        degree[at:at + 1024] = (sample[at:at + 1024] @ sample.T >= COSINE).sum(1)
    for i in np.argsort(-degree, kind="stable"):
        if degree[i] < least:
            break
        if free[i]:
            near = (sample @ sample[i] >= COSINE) & free
            centre = sample[near].sum(0)
            centre /= np.sqrt(centre @ centre)
            near = sample @ centre >= COSINE
            if (near & free).sum() >= least:
                out.append(centre)
                free &= ~near
    return np.array(out).reshape(-1, sample.shape[1])


def _heavy_links(index: DataFrame) -> DataFrame:
    """``cid, n, other`` a block of a heavy group: as ``_compared``, without the pairs inside its ball."""
    members = index.select("cid", "w", "v", "ball", "tight", F.explode("rims").alias("k")) \
                   .withColumn("tight", F.col("tight") & (F.col("ball") == F.col("k")))
    # One row a heavy group (at most 1 / HEAVY).
    sizes = members.groupBy("k").agg(F.ceil(F.count_if(~F.col("tight")) / SLICE).alias("loose"),
                                     F.ceil(F.count_if("tight") / SLICE).alias("balls")).filter("loose > 0")
    h = F.xxhash64("cid")
    own = F.when(F.col("tight"), F.col("loose") + F.pmod(h, F.greatest("balls", F.lit(1)))).otherwise(F.pmod(h, "loose"))
    with_ = F.explode(F.sequence(F.lit(0), F.when(F.col("tight"), F.col("loose")).otherwise(F.col("loose") + F.col("balls")) - 1))
    blocks = members.join(F.broadcast(sizes), "k").withColumn("own", own).withColumn("with", with_) \
                    .select("k", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b"), "own",
                            "cid", "w", "v", (F.col("ball") == F.col("k")).alias("core"), "tight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["k", "a", "b"]):
            cid, w, own, core, tight = (t.column(c).to_numpy() for c in ("cid", "w", "own", "core", "tight"))
            x = _unit(t.column("v").combine_chunks())
            left, right = (np.flatnonzero(own == t.column(c)[0].as_py()) for c in ("a", "b"))
            near = x[left] @ x[right].T >= COSINE
            near &= core[left][:, None] | core[right][None, :]
            near &= ~(tight[left][:, None] & tight[right][None, :])
            same = t.column("a")[0].as_py() == t.column("b")[0].as_py()
            if same:
                np.fill_diagonal(near, False)
            n = np.zeros(len(cid), np.int64)
            for at in range(0, len(left), 512):
                part = near[at:at + 512]
                n[left[at:at + 512]] += part @ w[right]
                if not same:
                    n[right] += w[left[at:at + 512]] @ part
            rank = np.empty(len(cid), np.int64)
            order = np.argsort(cid)
            rank[order] = np.arange(len(cid))
            while True:     # the least vector of each linked group of the block
                low = rank.copy()
                for at in range(0, len(left), 512):
                    part, some = near[at:at + 512], left[at:at + 512]
                    low[some] = np.minimum(low[some], np.where(part, low[right], len(cid)).min(1, initial=len(cid)))
                    low[right] = np.minimum(low[right], np.where(part, low[some][:, None], len(cid)).min(0, initial=len(cid)))
                if (low == rank).all():
                    break
                rank = low
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(cid[hit]), pa.array(n[hit]), pa.array(cid[order[rank[hit]]])],
                                             ["cid", "n", "other"])

    return blocks.repartition("k", "a", "b").sortWithinPartitions("k", "a", "b") \
                 .mapInArrow(run, "cid long, n long, other long")


def _split_again(index: DataFrame) -> DataFrame | None:
    """One more round over the leaves that are too large; None if there are none."""
    sizes = index.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("size")) \
                 .filter(F.col("size") > LEAF_MOST)
    sizes = stored(sizes, "large-leaves")
    if sizes.isEmpty():
        return None
    rows = index.select("cid", "v", F.explode("cells").alias("cell"))
    pick = F.pmod(F.xxhash64("cid", "cell"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * (SAMPLE // 2) / F.col("size")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["cell"]):
            cell, depth = t.column("cell")[0].as_py(), _depth(t.column("size")[0].as_py())
            bands = fit_splits(cell, depth, _unit(t.column("v").combine_chunks()))
            yield pa.RecordBatch.from_arrays([pa.array([cell]), pa.array([depth], pa.int32()),
                                              pa.array([bands.tobytes()])], ["cell", "depth", "bands"])

    models = stored(rows.join(sizes, "cell").filter(pick).select("cell", "size", "v").repartition("cell")
                    .sortWithinPartitions("cell").mapInArrow(fit, "cell long, depth int, bands binary"), "splits")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["cell"]):
            cell, depth = t.column("cell")[0].as_py(), t.column("depth")[0].as_py()
            bands = np.frombuffer(t.column("bands")[0].as_py()).reshape(-1, 2)
            row, code = descend(cell, depth, bands, _unit(t.column("v").combine_chunks()))
            yield pa.RecordBatch.from_arrays([pa.array(t.column("cid").to_numpy()[row]), pa.array(code)], ["cid", "cell"])

    small = rows.select("cid", "cell").join(sizes, "cell", "left_anti").select("cid", "cell")
    # A large leaf's rows stay spread over the join's tasks: splitting needs no group whole.
    large = rows.join(models, "cell").select("cid", "cell", "depth", "bands", "v") \
                .mapInArrow(split, "cid long, cell long")
    cells = small.union(large).groupBy("cid").agg(F.array_sort(F.collect_set("cell")).alias("cells"))
    return stored(index.drop("cells").join(cells, "cid").select("cid", "w", "v", "cells"), "forest")


def _compared(index: DataFrame) -> DataFrame:
    """``cid, n, other`` a leaf: weight of the partners counted there, the least vector linked there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["cell"]):
            if t.num_rows < 2:
                continue
            cid, w = (t.column(c).to_numpy() for c in ("cid", "w"))
            x = _unit(t.column("v").combine_chunks())
            near = x @ x.T >= COSINE
            np.fill_diagonal(near, False)
            i, j = np.nonzero(np.triu(near))
            if not len(i):
                continue
            own = _owned(t.column("cells").combine_chunks(), i, j, t.column("cell")[0].as_py())
            n = np.bincount(i[own], w[j[own]], len(cid)) + np.bincount(j[own], w[i[own]], len(cid))
            order = np.argsort(cid)
            rank = np.empty(len(cid), np.int64)
            rank[order] = np.arange(len(cid))
            while True:     # the least vector of each linked group of the leaf
                low = rank.copy()
                np.minimum.at(low, i, rank[j])
                np.minimum.at(low, j, rank[i])
                if (low == rank).all():
                    break
                rank = low
            hit = np.unique(np.concatenate([i, j]))
            yield pa.RecordBatch.from_arrays([pa.array(cid[hit]), pa.array(n[hit].astype(np.int64)),
                                              pa.array(cid[order[rank[hit]]])], ["cid", "n", "other"])

    return index.withColumn("cell", F.explode("cells")).repartition("cell").sortWithinPartitions("cell") \
                .select("cell", "cid", "w", "cells", "v").mapInArrow(run, "cid long, n long, other long")


def _owned(cells: pa.Array, i: np.ndarray, j: np.ndarray, cell: int) -> np.ndarray:
    """Whether ``cell`` is the least code that the vectors of each pair share."""
    lists = cells.to_pylist()
    wide = max(map(len, lists))
    codes = np.full((len(lists), wide), np.iinfo(np.int64).max)
    for k, c in enumerate(lists):
        below = [x for x in c if x < cell]
        codes[k, :len(below)] = below
    fill = np.iinfo(np.int64).max
    out = np.ones(len(i), bool)
    step = max(1, (1 << 23) // (wide * wide))
    for at in range(0, len(i), step):
        a, b = codes[i[at:at + step]], codes[j[at:at + step]]
        out[at:at + step] = ~((a[:, :, None] == b[:, None, :]) & (a[:, :, None] != fill)).any((1, 2))
    return out


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = stored(vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("vec_id"),
                                 F.when(usable, F.col(vector)).alias("v")), "vectors")
    classes = stored(rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("rid").alias("cid"), F.count("*").alias("w")), "distinct")
    found = None
    for d in classes.groupBy(F.size("v").alias("dim")).count().collect():
        planted = _planted(classes.filter(F.size("v") == d["dim"]), d["count"])
        index = planted.filter("ball < 0").select("cid", "w", "v", "cells")
        for _ in range(ROUNDS):
            again = _split_again(index)
            if again is None:
                break
            index = again
        tight = planted.filter("ball >= 0 AND tight")
        balls = tight.groupBy("ball").agg(F.sum("w").alias("all"), F.min("cid").alias("other"))
        inside = tight.select("cid", "ball", "w").join(F.broadcast(balls), "ball") \
                      .select("cid", (F.col("all") - F.col("w")).alias("n"), "other")
        both = stored(_compared(index).union(_heavy_links(planted)).union(inside), "links")
        found = both if found is None else found.union(both)
    if found is None:
        found = classes.select("cid", F.lit(0).cast("long").alias("n"), F.col("cid").alias("other")).limit(0)
    group = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b"))).withColumnRenamed("id", "cid")
    linked = classes.join(found.groupBy("cid").agg(F.sum("n").alias("n")), "cid", "left").join(group, "cid", "left") \
                    .select("v", F.coalesce("component", "cid").alias("component"),
                            (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    whole = rows.join(linked, "v", "left").drop("v").withColumn("component", F.coalesce("component", "rid"))
    least = whole.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return whole.join(least, "component").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
