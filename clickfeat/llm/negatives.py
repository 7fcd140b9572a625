"""Hard-negative mining over Hilbert-ordered blocks with zone maps (operator 13).

Vectors become integers, ``floor(256 * x)``. All usable rows are written as a
Parquet table of blocks, by label and then along a Hilbert curve (hilbert.py);
each block has a zone map: the least and greatest value of every dimension
and of the label. Anchors are packed into tiles in the same way.

1. *Zones.* The zone maps alone (the blocks' values are not read) are packed
   into pages, and every tile meets every page: the anchors are a stated set
   that is held against all rows, in blocks. For an anchor and a block,
   interval arithmetic bounds the score: the sums over dimensions of the
   lesser and the greater of ``a * lo`` and ``a * hi``.
2. *Positives.* Each anchor first reads the block of its label with the
   greatest bound; its fifth best score there (or none) is the threshold that a
   block's upper bound must reach to be read in the second pass.
3. *Negatives.* Every positive's score p gives a window [0.8 p, p]; a block is
   read for an anchor if it holds another label and its bounds meet one of
   the anchor's windows.

Read blocks go to tasks by (tile, group of blocks), the tile's own row first;
a task keeps the five best of each of the tile's windows, so what it emits
does not grow with the blocks it has read. Nothing loops on the driver, and
the number of jobs is the same for every size.

Defined cases: a NULL id, NULL label, NULL vector or a NULL or non-finite
component takes no part; vectors meet only vectors of their own length
(empty ones score 0); repeated rows count each and meet each other; a
negative positive score has an empty window; an anchor without positives or
negatives gives no rows; an empty table gives no rows. Components beyond
2 ** 27 raise an error, since their scores do not fit a long. Only the three
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import BATCH_ROWS, stored
from clickfeat.llm.hilbert import blocks, checked, finite, longs, products, unpacked, whole

SCALE, TOP = 256, 5
BLOCK_ROWS = 1024      # vectors of a candidate block
TILE_ROWS = 512        # anchors of a tile
PAGE_ROWS = 512        # zone maps of a page
GROUP_BLOCKS = 32      # blocks that a task reads for a tile, about
NONE, ALL = np.iinfo(np.int64).min, np.iinfo(np.int64).max
BATCH = "32"           # blocks, tiles or pages of an Arrow batch: some 100 KB each
CARRY = ("vec_id", "rid", "label")

TILE = "tile long, dim int, n int, vals binary, vec_id binary, rid binary, label binary"
PAIR = "tile long, block long, members binary"


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``rid, vec_id, label, dim, q`` of the rows that take part, every seventh id's label moved on."""
    label = F.col("label").cast("long")
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding")).select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.size("embedding").alias("dim"), whole("embedding", scale).alias("q"))
    return checked(rows)


def pages_of(table: DataFrame) -> DataFrame:
    """Zone maps of up to PAGE_ROWS blocks of one vector length, packed into one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def page(dim):
            rows = held.pop(dim)
            part = [np.array(c, np.int64) for c in zip(*rows, strict=True)]
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "zones": pa.array([len(rows)], pa.int32()),
                                               **{n: [c.tobytes()] for n, c in zip(("blocks", "lo", "hi", "label_lo", "label_hi"), part, strict=True)}})

        for b in batches:
            for r in b.to_pylist():
                held.setdefault(r["dim"], []).append((r["block"], r["lo"], r["hi"], r["label_lo"], r["label_hi"]))
                if len(held[r["dim"]]) == PAGE_ROWS:
                    yield page(r["dim"])
        for dim in list(held):
            yield page(dim)

    return table.select("block", "dim", "lo", "hi", "label_lo", "label_hi").mapInArrow(
        run, "dim int, zones int, blocks binary, lo binary, hi binary, label_lo binary, label_hi binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, since each one is large."""
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def interval(vals: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any point of each box."""
    up, down = np.maximum(vals, 0), np.minimum(vals, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def met(tiles: DataFrame, pages: DataFrame, slots: int) -> DataFrame:
    """Every tile with every page of its vector length, through ``slots`` join keys."""
    left = tiles.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    right = pages.withColumn("slot", F.pmod(F.xxhash64("blocks"), F.lit(slots)).cast("int")) \
        .withColumnsRenamed({"lo": "z_lo", "hi": "z_hi"})
    return left.join(right, ["dim", "slot"])


def _zones(r: dict):
    """A met row's anchors (vals, labels) and zones (blocks, boxes, label ranges)."""
    vals, z = unpacked(r["vals"], r["n"], r["dim"]), r["zones"]
    return (vals, longs(r["label"]), longs(r["blocks"]), longs(r["z_lo"]).reshape(z, r["dim"]),
            longs(r["z_hi"]).reshape(z, r["dim"]), longs(r["label_lo"]), longs(r["label_hi"]))


def best_blocks(pairs: DataFrame) -> DataFrame:
    """Each anchor's block of its own label with the greatest upper bound: (tile, block, members)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            vals, label, ids, lo, hi, l_lo, l_hi = _zones(r)
            most = interval(vals, lo, hi)[1]
            own = (l_lo[None, :] <= label[:, None]) & (label[:, None] <= l_hi[None, :])
            most = np.where(own, most, NONE)
            at = most.argmax(1)
            a = np.flatnonzero(own.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), r["tile"])), pa.array(a.astype(np.int32)), pa.array(most[a, at[a]]), pa.array(ids[at[a]])],
                ["tile", "a", "most", "block"])

    each = pairs.mapInArrow(run, "tile long, a int, most long, block long")
    one = each.groupBy("tile", "a").agg(F.max(F.struct("most", "block")).alias("x"))
    return _members(one.select("tile", "a", F.col("x.block").alias("block")))


def _members(rows: DataFrame) -> DataFrame:
    """(tile, block, a) grouped to one row a (tile, block); a tile bounds the group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield pa.RecordBatch.from_pydict({"tile": pa.array([r["tile"]]), "block": pa.array([r["block"]]),
                                                  "members": [np.array(sorted(r["a"]), np.int32).tobytes()]})

    return rows.groupBy("tile", "block").agg(F.collect_set("a").alias("a")).mapInArrow(run, PAIR)


def reached(pairs: DataFrame, own: bool) -> DataFrame:
    """The blocks whose bounds meet a window of an anchor: (tile, block, members).

    ``windows`` holds, for each anchor, pairs of least and greatest score;
    ``own`` asks for blocks that hold the anchor's label, else another one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            vals, label, ids, lo, hi, l_lo, l_hi = _zones(r)
            window = longs(r["windows"]).reshape(len(vals), -1, 2)
            least, most = interval(vals, lo, hi)
            hit = np.zeros(least.shape, bool)
            for w in range(window.shape[1]):
                hit |= (most >= window[:, w, :1]) & (least <= window[:, w, 1:])
            if own:
                hit &= (l_lo[None, :] <= label[:, None]) & (label[:, None] <= l_hi[None, :])
            else:
                hit &= (l_lo[None, :] != label[:, None]) | (l_hi[None, :] != label[:, None])
            take = np.flatnonzero(hit.any(0))
            yield pa.RecordBatch.from_pydict({
                "tile": pa.array(np.full(len(take), r["tile"]), pa.int64()), "block": pa.array(ids[take], pa.int64()),
                "members": pa.array([np.flatnonzero(hit[:, z]).astype(np.int32).tobytes() for z in take.tolist()], pa.binary())})

    return pairs.mapInArrow(run, PAIR)


def read_blocks(tiles: DataFrame, pairs: DataFrame, table: DataFrame, groups: int, own: bool) -> DataFrame:
    """The best rows of every window from the chosen blocks: (tile, a, w, score, vec_id, rid).

    Each (tile, group of blocks) is one run of rows: the tile, then its
    blocks. ``TOP`` rows a window leave it, in the final order.
    """
    group = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("g")
    chosen = pairs.select("tile", "block", "members", group)
    values = chosen.join(table.select("block", "n", "dim", "vals", *CARRY), "block") \
        .select("tile", "g", F.lit(1).alias("kind"), "members", "n", "dim", "vals", *CARRY, F.lit(None).cast("binary").alias("windows"))
    heads = chosen.select("tile", "g").distinct().join(tiles, "tile") \
        .select("tile", "g", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("members"), "n", "dim", "vals", *CARRY, "windows")
    rows = heads.unionByName(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = state = None
        for r in _rows(batches):
            if r["kind"] == 0:
                if state is not None:
                    yield from state.rows(at)
                at, state = r["tile"], Best(r, own)
            else:
                state.add(r)
        if state is not None:
            yield from state.rows(at)

    tasks = max(groups, tiles.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, "tile", "g").sortWithinPartitions("tile", "g", "kind") \
               .mapInArrow(run, "tile long, a int, w int, score long, vec_id long, rid long")


class Best:
    """The ``TOP`` best rows so far of every window of a tile's anchors."""

    def __init__(self, tile: dict, own: bool) -> None:
        self.own = own
        self.vals = unpacked(tile["vals"], tile["n"], tile["dim"])
        self.rid, self.label = longs(tile["rid"]), longs(tile["label"])
        self.window = longs(tile["windows"]).reshape(len(self.vals), -1, 2)
        self.best: dict[tuple[int, int], np.ndarray] = {}          # rows: score, vec_id, rid
        self.least = self.window[:, :, 0].copy()                    # below it a row cannot enter

    def add(self, block: dict) -> None:
        members = np.frombuffer(block["members"], np.int32)
        vals = unpacked(block["vals"], block["n"], block["dim"])
        ids, rid, label = (longs(block[c]) for c in CARRY)
        scores = products(self.vals[members], vals)
        fits = (label[None, :] == self.label[members, None]) == self.own
        if self.own:
            fits &= rid[None, :] != self.rid[members, None]
        for w in range(self.window.shape[1]):
            hit = fits & (scores >= self.least[members, w, None]) & (scores <= self.window[members, w, 1, None])
            for k in np.flatnonzero(hit.any(1)).tolist():
                a, own = int(members[k]), np.flatnonzero(hit[k])
                rows = np.stack([scores[k, own], ids[own], rid[own]])
                if (a, w) in self.best:
                    rows = np.concatenate([self.best[a, w], rows], 1)
                rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[:TOP]]
                self.best[a, w] = rows
                if rows.shape[1] == TOP:
                    self.least[a, w] = rows[0, -1]

    def rows(self, tile: int) -> Iterator[pa.RecordBatch]:
        if self.best:
            sizes = [r.shape[1] for r in self.best.values()]
            a, w = (np.repeat(np.array(c, np.int32), sizes) for c in zip(*self.best, strict=True))
            score, ids, rid = np.concatenate(list(self.best.values()), 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), tile)), pa.array(a), pa.array(w), pa.array(score),
                                              pa.array(ids), pa.array(rid)], ["tile", "a", "w", "score", "vec_id", "rid"])


def best_of(rows: DataFrame) -> DataFrame:
    """The first ``TOP`` rows of every window, over all groups of blocks."""
    order = Window.partitionBy("tile", "a", "w").orderBy(F.desc("score"), "vec_id", "rid")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def with_windows(tiles: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """``tiles`` with each anchor's ``width`` score windows as bytes.

    ``rows`` are (tile, a, w, lo, hi), at most ``width`` an anchor; a window
    that has no row is empty.
    """
    packs = rows.groupBy("tile").agg(F.collect_list(F.struct("a", "w", "lo", "hi")).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for n, x in zip(b.column("n").to_pylist(), b.column("x").to_pylist(), strict=True):
                window = np.full((n, width, 2), (ALL, NONE), np.int64)
                for v in x or ():
                    window[v["a"], v["w"]] = v["lo"], v["hi"]
                out.append(window.tobytes())
            at = b.schema.get_field_index("x")
            yield pa.RecordBatch.from_arrays([*(c for k, c in enumerate(b.columns) if k != at), pa.array(out, pa.binary())],
                                             [*(c for c in b.schema.names if c != "x"), "windows"])

    return tiles.join(packs, "tile", "left").select(*TILE_COLUMNS, "x").mapInArrow(run, f"{TILE}, windows binary")


TILE_COLUMNS = [c.split()[0] for c in TILE.split(", ")]


def hard_negatives(vectors: DataFrame, every: int = 100, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, scale), "negatives-rows")
    table = blocks(rows, "negatives-blocks", BLOCK_ROWS, CARRY, lead=("label",))
    tiles = blocks(rows.filter(F.col("vec_id") % every == 0), "negatives-tiles", TILE_ROWS, CARRY, lead=("label",)) \
        .withColumnRenamed("block", "tile").select(*TILE_COLUMNS)
    count = table.count()
    spread = table.repartition(F.pmod(F.xxhash64("block"), F.lit(max(1, -(-count // PAGE_ROWS)))))
    pages = stored(pages_of(spread), "negatives-pages")
    slots, groups = max(1, pages.count()), max(1, -(-count // GROUP_BLOCKS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    try:
        return stored(_mined(rows, table, tiles, pages, slots, groups), "negatives")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _mined(rows: DataFrame, table: DataFrame, tiles: DataFrame, pages: DataFrame, slots: int, groups: int) -> DataFrame:
    anchors = stored(tiles.mapInArrow(_anchor_rows, "tile long, a int, rid long")
                     .join(rows.select("rid", F.col("vec_id").alias("anchor_id")), "rid"), "negatives-anchors")
    score, top = F.col("score"), F.lit(int(ALL))

    # A first read of one block an anchor gives the least score that its positives reach.
    open_ = anchors.select("tile", "a", F.lit(0).alias("w"), F.lit(int(NONE)).alias("lo"), top.alias("hi"))
    open_ = stored(with_windows(tiles, open_, 1), "negatives-open")
    first = stored(best_blocks(met(open_, pages, slots)), "negatives-first")
    seen = best_of(read_blocks(open_, first, table, groups, own=True))
    least = seen.groupBy("tile", "a").agg(F.count("*").alias("n"), F.min("score").alias("lo")).filter(F.col("n") == TOP)
    least = anchors.join(least, ["tile", "a"], "left") \
        .select("tile", "a", F.lit(0).alias("w"), F.coalesce("lo", F.lit(int(NONE))).alias("lo"), top.alias("hi"))
    bounded = stored(with_windows(tiles, least, 1), "negatives-bounded")
    chosen = stored(reached(met(bounded, pages, slots), own=True), "negatives-near")
    positives = stored(best_of(read_blocks(bounded, chosen, table, groups, own=True))
                       .select("tile", "a", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"),
                               score.alias("positive_score")), "negatives-positives")

    # Window w of an anchor is that of its positive w: [0.8 p, p], empty below zero.
    p = F.col("positive_score")
    window = positives.filter(p >= 0).select("tile", "a", "w", (p - F.expr("positive_score div 5")).alias("lo"), p.alias("hi"))
    windows = stored(with_windows(tiles, window, TOP), "negatives-windows")
    chosen = stored(reached(met(windows, pages, slots), own=False), "negatives-met")
    found = best_of(read_blocks(windows, chosen, table, groups, own=False)) \
        .select("tile", "a", "w", "rank", F.col("vec_id").alias("negative_id"), score.alias("negative_score"))
    return positives.join(found, ["tile", "a", "w"]).join(anchors, ["tile", "a"]) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for tile, rid in zip(b.column("tile").to_pylist(), b.column("rid").to_pylist(), strict=True):
            own = longs(rid)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), tile)), pa.array(np.arange(len(own), dtype=np.int32)), pa.array(own)],
                                             ["tile", "a", "rid"])
