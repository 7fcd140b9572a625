"""Integer vectors in Hilbert order, cut into blocks with min/max boxes.

Shared by centroid clustering (operator 11) and hard-negative mining
(operator 13). A vector's place on the curve is that of its grid cell: the
axes are the dimensions of largest spread, cut into equal cells over the mean
plus and minus two standard deviations (sums over all rows; outer values fall
into the outer cells). Rows are ranged by place, so neighbours share a block;
copies of one vector share a place and are dealt out by a running number, so
that no task gets them all.

Boxes are exact minima and maxima of the integers, whatever the order: the
curve decides only how tight they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.llm.common import stored

AXES, BITS = 12, 4     # dimensions of the curve, bits of each
LARGEST = 1 << 27      # components beyond it would not leave room for exact sums

def finite(vector: str) -> Column:
    """Whether a vector is there and holds numbers only."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def whole(vector: str, scale: int) -> Column:
    """Every component as the integer ``floor(scale * x)``."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def checked(rows: DataFrame) -> DataFrame:
    """``rows`` whose integers ``q`` leave room for exact sums; others raise."""
    wide = F.exists("q", lambda x: (x > LARGEST) | (x < -LARGEST))
    return rows.withColumn("q", F.when(wide, F.raise_error(F.lit("a component is too large for exact scores"))
                                       .cast("array<bigint>")).otherwise(F.col("q")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def curve_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of grid cells (whole numbers below ``2 ** bits``).

    A point's binary digits, most significant first, name nested sub-cubes.
    Going down, each sub-cube's own curve is the parent's under exchanges and
    reflections of axes, which are undone digit by digit; the Gray code of the
    corrected digits is the place.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        top, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(n):
            up = (x[i] & top) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] & np.uint64(1 << b)) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << one) | ((x[i] >> np.uint64(b)) & one)
    return place


def spreads(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each vector length: the axes of largest spread, their mean and deviation.

    One row a length reaches the driver, whose size is that of three vectors.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                m = matrix(b.filter(pa.array(dims == dim)).column("q"), dim).astype(float)
                n, s, sq = held.get(dim, (0, 0.0, 0.0))
                held[dim] = (n + len(m), s + m.sum(0), sq + (m * m).sum(0))
        for dim, (n, s, sq) in held.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "n": pa.array([n], pa.int64()),
                "s": pa.array([np.atleast_1d(s).tolist()], pa.list_(pa.float64())),
                "sq": pa.array([np.atleast_1d(sq).tolist()], pa.list_(pa.float64()))})

    part = rows.select("dim", "q").mapInArrow(run, "dim int, n long, s array<double>, sq array<double>")
    each = part.select("dim", "n", F.posexplode(F.arrays_zip("s", "sq"))).groupBy("dim", "pos").agg(
        F.sum("n").alias("n"), F.sum("col.s").alias("s"), F.sum("col.sq").alias("sq"))
    top = each.select("dim", F.struct((F.col("sq") / F.col("n") - (F.col("s") / F.col("n")) ** 2).alias("v"),
                                      F.col("pos").alias("at"), (F.col("s") / F.col("n")).alias("mean")).alias("x")) \
              .groupBy("dim").agg(F.slice(F.sort_array(F.collect_list("x"), asc=False), 1, AXES).alias("x"))
    out = {}
    for r in top.collect():
        out[r["dim"]] = (np.array([x["at"] for x in r["x"]]), np.array([x["mean"] for x in r["x"]]),
                         np.sqrt(np.maximum([x["v"] for x in r["x"]], 0)) + 1e-9)
    return out


def with_place(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``dim`` and ``q``) with a column ``place`` on the curve of their length."""
    axes = spreads(rows)
    schema = T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            place = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                if dim not in axes:
                    continue
                at, mean, dev = axes[dim]
                own = np.flatnonzero(dims == dim)
                m = matrix(b.column("q").take(pa.array(own)), dim)[:, at]
                side = 1 << BITS
                cell = np.clip(np.floor(((m - mean) / (4 * dev) + 0.5) * side), 0, side - 1)
                place[own] = curve_place(cell, BITS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], [*b.schema.names, "place"])

    return rows.mapInArrow(run, schema)


def _bytes(m: np.ndarray) -> bytes:
    """A matrix of whole numbers in the narrowest of 2, 4 or 8 bytes each."""
    top = int(np.abs(m).max(initial=0))
    return m.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64).tobytes()


def unpacked(vals: bytes, n: int, dim: int) -> np.ndarray:
    """``n`` vectors of ``dim`` whole numbers from the bytes of ``_bytes``."""
    width = len(vals) // (n * dim) if n * dim else 8
    return np.frombuffer(vals, f"i{width}").astype(np.int64).reshape(n, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2.0 ** 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def longs(values: bytes) -> np.ndarray:
    return np.frombuffer(values, np.int64)


def blocks(rows: DataFrame, name: str, size: int, carry: tuple[str, ...], lead: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` (dim, q and the whole-number columns ``carry``) as a stored table of blocks in Hilbert order.

    A block holds up to ``size`` vectors of one length: their integers
    (``vals``) and carried columns as bytes, the box of its vectors (``lo``,
    ``hi``) and of each carried column (``c_lo``, ``c_hi``). Rows are ordered
    by ``lead`` first, then along the curve. ``block`` numbers the blocks.
    """
    spark = rows.sparkSession
    placed = stored(with_place(rows), f"{name}-places")
    # About sixteen blocks a task, and no fewer tasks than cores.
    tasks = max(spark.sparkContext.defaultParallelism, -(-placed.count() // (16 * size)))
    # The last column deals out copies, which all have one place.
    placed = placed.withColumn("tie", F.monotonically_increasing_id())
    order = ["dim", *lead, "place", "tie"]
    schema = "block long, dim int, n int, vals binary, lo array<bigint>, hi array<bigint>" + "".join(
        f", {c} binary, {c}_lo long, {c}_hi long" for c in carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        held: list = []                     # (values, carried columns) of one length
        for dim, own in _by_length(batches):
            if held and (held[0][0].shape[1] != dim or sum(len(v) for v, _ in held) >= size):
                for out in _packed(held, size, carry, block):
                    yield out
                    block += 1
                held = []
            held.append((matrix(own.column("q"), dim), [own.column(c).to_numpy().astype(np.int64) for c in carry]))
        if held:
            yield from _packed(held, size, carry, block)

    dealt = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("dim", "q", *carry)
    return stored(dealt.mapInArrow(run, schema), name)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Pieces of one vector length, from batches sorted by it."""
    for b in batches:
        if b.num_rows:
            dims = b.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), b.num_rows]
            for lo, hi in pairwise(cuts):
                yield int(dims[lo]), b.slice(lo, hi - lo)


def _packed(held: list, size: int, carry: tuple[str, ...], block: int) -> Iterator[pa.RecordBatch]:
    vals = np.concatenate([v for v, _ in held])
    carried = [np.concatenate(c) for c in zip(*(c for _, c in held), strict=True)]
    for at in range(0, len(vals), size):
        v = vals[at:at + size]
        row = {"block": pa.array([block], pa.int64()), "dim": pa.array([v.shape[1]], pa.int32()),
               "n": pa.array([len(v)], pa.int32()), "vals": [_bytes(v)],
               "lo": pa.array([v.min(0).tolist()], pa.list_(pa.int64())),
               "hi": pa.array([v.max(0).tolist()], pa.list_(pa.int64()))}
        for name, values in zip(carry, carried, strict=True):
            own = values[at:at + size]
            row |= {name: [own.tobytes()], f"{name}_lo": pa.array([int(own.min())], pa.int64()),
                    f"{name}_hi": pa.array([int(own.max())], pa.int64())}
        yield pa.RecordBatch.from_pydict(row)
        block += 1
