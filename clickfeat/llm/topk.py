"""Exact top-k search by distributed histogram selection (operator 6).

Vectors are turned into integers, ``floor(64 * x)``, and packed into blocks.
The stated query set is taken in blocks of at most ``QUERY_BLOCK`` vectors
(the only thing broadcast, so its size is bounded whatever the table's).
For each query block every task scores its blocks of candidates and adds to
one histogram per query over that query's current score interval; the
histograms are summed, the interval shrinks to the bin that holds the kth
value, and the next round refines it, until the interval is one integer: the
exact kth score. A last pass keeps the scores that reach it. Among equal kth
scores each block can contribute its ``k`` smallest ids at most, so ties of
any number stay small and the final ranking is exact.

Defined cases: a vector that is NULL, empty, or holds NULL or non-finite
components takes no part, nor does a NULL id; repeated rows of one id count
once (the least vector); vectors meet only vectors of their own length; all
candidates are returned when there are fewer than ``k``; an empty table gives
no rows. Scores must fit a long. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import stored
from clickfeat.session import fresh_dir

QUERY_BLOCK = 4096    # queries scored together, at most
BLOCK_ROWS = 2048     # candidates scored together
BINS = 256            # bins of one round's histogram
EXACT = 2 ** 53       # beyond this the products are formed in integers


def quantized(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, dim, q``: one integer vector per usable id."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    q = F.transform(vector, lambda x: F.floor(F.lit(64.0) * x.cast("double")))
    rows = vectors.filter(F.col(key).isNotNull() & (F.size(vector) > 0) & finite) \
                  .select(F.col(key).cast("long").alias("vec_id"), q.alias("q"))
    return rows.groupBy("vec_id").agg(F.min("q").alias("q")).withColumn("dim", F.size("q"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of up to BLOCK_ROWS vectors of one length: ids and values as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim):
            ids, vals = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            top = float(np.sqrt((vals.astype(float) ** 2).sum(1)).max())
            for at in range(0, len(ids), BLOCK_ROWS):
                part = slice(at, at + BLOCK_ROWS)
                yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": [ids[part].tobytes()],
                                                  "vals": [vals[part].tobytes()], "top": [top]})

        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = b.filter(pa.array(dims == dim))
                held.setdefault(dim, []).append((own.column("vec_id").to_numpy(), _matrix(own.column("q"), dim)))
                if sum(len(i) for i, _ in held[dim]) >= BLOCK_ROWS:
                    yield from block(dim)
        for dim in list(held):
            yield from block(dim)

    return rows.select("vec_id", "dim", "q").mapInArrow(run, "dim int, ids binary, vals binary, top double")


def _scores(queries: np.ndarray, block: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of queries (rows) and candidates (columns), as integers."""
    if exact:
        return queries @ block.T
    return (queries.astype(np.float64) @ block.astype(np.float64).T).astype(np.int64)


def _pairs(batches, query_ids, queries, dim, exact):
    """(query offset, candidate ids, scores) piece by piece; a query's own id scores nothing."""
    for b in batches:
        for ids, vals in zip(b.column("ids").to_pylist(), b.column("vals").to_pylist(), strict=True):
            cand = np.frombuffer(ids, np.int64)
            block = np.frombuffer(vals, np.int64).reshape(-1, dim)
            for at in range(0, len(query_ids), 512):
                own = query_ids[at:at + 512, None] == cand[None, :]
                yield at, cand, _scores(queries[at:at + 512], block, exact), own


def _histograms(blocks: DataFrame, shipped, dim: int, exact: bool) -> DataFrame:
    """Summed histograms of the current intervals: query offset, counts (BINS + 1 cells).

    The last cell counts scores above the interval.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, low, width = shipped.value
        total = np.zeros((len(ids), BINS + 1), np.int64)
        for at, _, scores, own in _pairs(batches, ids, queries, dim, exact):
            n = len(scores)
            cell = (scores - low[at:at + n, None]) // width[at:at + n, None]
            np.minimum(cell, BINS, out=cell)
            keep = (cell >= 0) & ~own
            flat = (cell + np.arange(n)[:, None] * (BINS + 1))[keep]
            total[at:at + n] += np.bincount(flat, minlength=n * (BINS + 1)).reshape(n, BINS + 1)
        rows = np.flatnonzero(total.any(1))
        for at in range(0, len(rows), 512):
            part = rows[at:at + 512]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array([r.tobytes() for r in total[part]], pa.binary())],
                ["q", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for q, c in zip(b.column("q").to_pylist(), b.column("counts").to_pylist(), strict=True):
                cells = np.frombuffer(c, np.int64)
                sums[q] = sums[q] + cells if q in sums else cells
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())],
            ["q", "counts"])

    schema = "q int, counts binary"
    return blocks.mapInArrow(run, schema).repartition("q").mapInArrow(add, schema)


def _reaching(blocks: DataFrame, shipped, dim: int, exact: bool, k: int) -> DataFrame:
    """Pairs whose score reaches the query's kth score (ties: k least ids a block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, least, _ = shipped.value
        for at, cand, scores, own in _pairs(batches, ids, queries, dim, exact):
            n = len(scores)
            reach = (scores >= least[at:at + n, None]) & ~own
            out = []
            for q in np.flatnonzero(reach.any(1)):
                hit = np.flatnonzero(reach[q])
                if len(hit) > k:
                    hit = hit[np.lexsort((cand[hit], -scores[q, hit]))[:k]]
                out.append((np.full(len(hit), ids[at + q]), cand[hit], scores[q, hit]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                 ["query_id", "vec_id", "score"])

    return blocks.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of every id divisible by ``every``."""
    spark = vectors.sparkSession
    rows = stored(quantized(vectors, key, vector), "topk-vectors")
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-rows.count() // (8 * BLOCK_ROWS)))
    blocks = stored(packed(rows.repartition(tasks)), "topk-blocks")
    queries = rows.filter(F.col("vec_id") % every == 0)
    path = fresh_dir(spark, "topk-reaching")
    pairs = "query_id long, vec_id long, score long"
    spark.createDataFrame([], pairs).write.parquet(path)
    sizes = {r["dim"]: r["count"] for r in queries.groupBy("dim").count().collect()}
    for found in blocks.groupBy("dim").agg(F.max("top").alias("top")).collect():
        dim, top = found["dim"], found["top"]
        # Distinct ids spread evenly over the hash, so half the bound leaves ample room.
        parts = -(-2 * sizes.get(dim, 0) // QUERY_BLOCK)
        for n in range(parts):
            part = queries.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == n)) \
                          .select("vec_id", "q").limit(QUERY_BLOCK + 1).toPandas()
            if len(part) > QUERY_BLOCK:
                raise RuntimeError("a block of queries exceeds its bound")
            if len(part):
                _select(spark, blocks.filter(F.col("dim") == dim).select("ids", "vals"), part, dim, top, k) \
                    .write.mode("append").parquet(path)
    out = spark.read.schema(pairs).parquet(path)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
              .select("query_id", "rank", "vec_id", "score")


def _select(spark, blocks: DataFrame, part, dim: int, top: float, k: int) -> DataFrame:
    """Refine the kth score of each query of one block, then keep what reaches it."""
    ids = part["vec_id"].to_numpy(np.int64)
    q = np.array(part["q"].tolist(), dtype=np.int64).reshape(-1, dim)
    norms = np.sqrt((q.astype(float) ** 2).sum(1))
    exact = bool(norms.max() * top >= EXACT)
    bound = np.ceil(norms * top * (1 + 1e-9)).astype(np.int64) + 1
    low, size = -bound, 2 * bound + 1
    live = np.ones(len(ids), bool)            # intervals that still hold more than one integer
    while live.any():
        pick = np.flatnonzero(live)
        width = -(-size[pick] // BINS)
        shipped = spark.sparkContext.broadcast((ids[pick], q[pick], low[pick], width))
        size[pick] = 1                                # no candidate: nothing to locate
        for row in _histograms(blocks, shipped, dim, exact).toLocalIterator():
            i = pick[row["q"]]
            counts = np.frombuffer(row["counts"], np.int64)
            down = np.cumsum(counts[::-1])            # from the top cell: above, then bins downward
            if down[-1] < k:                          # fewer candidates than k: all reach
                low[i], size[i] = -bound[i], 1
                continue
            cell = BINS - int(np.searchsorted(down, k))
            low[i] += cell * width[row["q"]]
            size[i] = width[row["q"]]
        live = size > 1
        shipped.destroy()
    shipped = spark.sparkContext.broadcast((ids, q, low, None))
    return _reaching(blocks, shipped, dim, exact, k)
