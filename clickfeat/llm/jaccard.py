"""N-gram Jaccard join by count-vector R-trees (operator 5).

A document's set holds its distinct 5-word shingles (as 64-bit hashes; fewer
words: the whole sequence). The shingles are hashed into groups, and the
document is the point of its group counts. For two points the sum of the
coordinate minima bounds the overlap from above, so an R-tree node, which
keeps the coordinate maxima and least size of the points below it, is left
out when its summed minima with a query miss the overlap that a Jaccard
similarity of 0.8 needs. Surviving pairs are verified on the sets.

Points of random sets crowd together, so one tree over all of them would be
searched nearly whole by each query. The points are therefore first dealt to
blocks: two sets of that similarity share one of their first ``n - ceil(0.8 n)
+ 1`` shingles in any common order. Each block (documents with one such shingle
in common; equal blocks once) gets its tree, and no other pair can be similar.
The order is by hash, with shingles that are frequent in some task's rows last, so
that a passage shared by many documents makes no block unless nearly all of a
document is such passages.

Equal sets are one point, known by a 64-bit hash of the set. Points are small and
move to their blocks. The sets are larger than their texts, so they are never kept
for all documents: a pass that needs them makes them from the texts again, and only the sets of
surviving pairs move, where a bitmap of fixed size tells the tasks that read the texts which
those are (one that fills up lets more through, to the join that decides). Blocks of more than a few sets may be of any size: their
blocks of one least set are made one, points are first compared with a leader each, and once the verified links are
joined to components only points outside a block's largest component are searched for,
slice by slice. Trees hold coarse points, a byte for every four to eight shingles; the
pairs they let through are bounded again by whole points. So no task holds an unbounded block, and no group's pairs are listed.

Defined cases: NULL, empty and white-space texts have the empty set and link
with nothing; repeated rows are rows of one set; NULL doc_ids never become a
component's id unless a group has no other; texts of any length give all their
shingles; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import bounded_top, components, discard, grouped, raw, stored
from clickfeat.llm.hashing import BASE, MULTIPLIERS, U, Words, lots, mixed, run_hashes

SHINGLE = 5
# Similarity PART / WHOLE: links need WHOLE * overlap >= PART * union.
PART, WHOLE = 4, 5
FREQUENT = 16          # rows of one task that make a shingle frequent
BLOCK = 16             # sets of a block whose pairs are searched without leaders first, at most
FREQUENT_KEPT = 50_000  # frequent shingles put last, at most (the commonest)
FANOUT = 16            # children of an R-tree node
SLICE = 1024           # points of a frequent block searched together
ROUNDS = 3             # rounds of leaders before the search across components
FULL = 255             # greatest number in a coarse point
MET = 1 << 18           # sets that a task remembers, at most
BITMAP = 27            # its size is 2 to this power, in bits
SEGMENT = 19           # and that of the pieces it is made of


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    found = Words(texts)
    word, grams = found.hash, np.zeros(0, np.uint64)
    if len(word) >= SHINGLE:
        last = len(word) - SHINGLE + 1
        grams = mixed(sum(word[j:last + j] * MULTIPLIERS[j] for j in range(SHINGLE)))
    out = []
    for lo, hi in pairwise(found.cuts.tolist()):
        if hi - lo >= SHINGLE:
            out.append(np.unique(grams[lo:hi - SHINGLE + 1]))
        else:
            out.append(run_hashes(word, np.array([lo]), np.array([hi])) if hi > lo else np.zeros(0, np.uint64))
    return out


def set_hash(h: np.ndarray) -> int | None:
    """The hash that equal sets share; None for the empty set."""
    if not len(h):
        return None
    both = np.array([h.sum(dtype=np.uint64), mixed(h ^ BASE).sum(dtype=np.uint64)])
    return int(run_hashes(both, np.zeros(1, int), np.full(1, 2)).view(np.int64)[0])


def prefix_size(n: int) -> int:
    """How many first shingles of a set must meet those of any similar set."""
    return n - -(-PART * n // WHOLE) + 1


def needed(a, b):
    """The overlap below which sets of sizes a and b are not similar."""
    return -(-PART * (a + b) // (PART + WHOLE))


def groups_of(n: int) -> int:
    """Groups of a point: a power of two that leaves one or two shingles to each.

    With more to a group, unlike shingles of two sets meet in one by chance
    and the bound lets pairs through that are some way below the similarity.
    """
    return max(8, 1 << max(0, n.bit_length() - 1))


def coarse(point: np.ndarray) -> np.ndarray:
    """A point of a quarter of the groups, in bytes; FULL stands for any number from there on."""
    m = max(8, len(point) // 4)
    return np.minimum(point.reshape(-1, m).sum(0, dtype=np.int64), FULL).astype(np.uint8)


def _packed(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _tokens(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


class Tally:
    """Shingles that a task meets more than once in a batch, with their numbers; of bounded size."""

    def __init__(self):
        self.token, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, tokens: np.ndarray) -> None:
        own, n = np.unique(tokens, return_counts=True)
        both, at = np.unique(np.concatenate([self.token, own[n > 1]]), return_inverse=True)
        self.count = np.bincount(at, np.concatenate([self.count, n[n > 1]]), len(both)).astype(np.int64)
        self.token = both
        if len(both) > 400_000:
            kept = self.count >= FREQUENT // 4
            self.token, self.count = self.token[kept], self.count[kept]

    def commonest(self) -> np.ndarray:
        """Rows of a shingle and its number, the frequent ones (FREQUENT_KEPT at most)."""
        rows = np.stack([self.token.astype(np.int64), self.count], 1)[self.count >= FREQUENT]
        return rows[np.lexsort((rows[:, 0], -rows[:, 1]))[:FREQUENT_KEPT]]


ROWS = ("rid long, {key}n long, cid long, point binary, frequent array<long>")


def document_sets(docs: DataFrame) -> DataFrame:
    """One row a document: size, set hash ``cid``, and the point of its set (upper 48 bits of the hashes).

    A task adds rows without ``rid`` that name its frequent shingles.
    """
    kind = dict(docs.dtypes)["doc_id"]
    source = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                         F.xxhash64("text").alias("text_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Tally()
        doc_type = None
        for b in batches:
            doc_type = b.schema.field("doc_id").type
            sizes, cids, points = [], [], []
            heads = []
            for part in lots([t or b"" for t in raw(b.column("text"))]):
                for h in shingle_sets(part):
                    n = len(h)
                    sizes.append(n)
                    cids.append(set_hash(h))
                    t = h >> U(16)
                    m = groups_of(n)
                    points.append(np.bincount((t & U(m - 1)).astype(np.int64), minlength=m).astype("<u2").tobytes())
                    if n:
                        heads.append(t[:prefix_size(n)])
            if heads:
                seen.add(np.concatenate(heads))
            none = pa.array([None] * len(sizes), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), b.column("text_key"), pa.array(sizes, pa.int64()),
                 pa.array(cids, pa.int64()), pa.array(points, pa.binary()), none], names)
        hot = seen.commonest()
        if len(hot):
            cells = [pa.array([None], x) for x in (pa.int64(), doc_type, pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*cells, pa.array([hot.ravel()], pa.list_(pa.int64()))], names)

    names = ["rid", "doc_id", "text_key", "n", "cid", "point", "frequent"]
    return stored(source.mapInArrow(run, ROWS.format(key=f"doc_id {kind}, text_key long, ")), "sets")


def _frequent(sets: DataFrame) -> np.ndarray:
    """The commonest frequent shingles, sorted (at most FREQUENT_KEPT)."""
    pairs = sets.filter("rid IS NULL").select(F.posexplode("frequent").alias("i", "x"), "frequent")
    counts = pairs.filter("i % 2 = 0").select(F.col("x").alias("token"), F.element_at("frequent", F.col("i") + 2).alias("c"))
    top = bounded_top(counts.groupBy("token").agg(F.sum("c").alias("c")), "c", FREQUENT_KEPT)
    return np.sort(np.array([r["token"] for r in top.select("token").collect()], np.uint64))


class Met:
    """The keys that a task has met, as far as it remembers (the last one at each place)."""

    def __init__(self):
        self.last, self.used = np.zeros(MET, np.int64), np.zeros(MET, bool)

    def new(self, keys: list[int]) -> np.ndarray:
        """Which of ``keys`` are met for the first time, within them too."""
        out = np.zeros(len(keys), bool)
        for i, k in enumerate(keys):
            at = k % MET
            out[i] = not self.used[at] or self.last[at] != k
            self.last[at], self.used[at] = k, True
        return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.filter("text IS NOT NULL").select(F.xxhash64("text").alias("text_key"), "text")


def _prefixes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``token, cid, common``: the first shingles of each set in the common order.

    A text or set that a task meets again is left out (as far as it remembers).
    """
    shipped = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shipped.value
        texts, sets = Met(), Met()
        for b in batches:
            keys, ids, common = [], [], []
            b = b.filter(pa.array(texts.new(b.column("text_key").to_pylist())))
            for part in lots(raw(b.column("text"))):
                for h in shingle_sets(part):
                    cid = set_hash(h)
                    if cid is None or not sets.new([cid])[0]:
                        continue
                    t, size = h >> U(16), prefix_size(len(h))
                    at = np.searchsorted(hot, t)
                    late = np.zeros(len(t), bool) if not len(hot) else hot[np.minimum(at, len(hot) - 1)] == t
                    order = np.concatenate([np.flatnonzero(~late), np.flatnonzero(late)])[:size]
                    keys.append(t[order])
                    ids.append(np.full(size, cid))
                    common.append(late[order])
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(ids)),
                     pa.array(np.concatenate(common))], ["token", "cid", "common"])

    return _texts(docs).mapInArrow(run, "token long, cid long, common boolean")


def _blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The short blocks (``key, members``) and the rows of larger ones (``token, cid``), by
    the shingles that are not put last.

    Equal short blocks (up to BLOCK sets) are one. A shingle that no task met
    FREQUENT times has few rows for each task of the reading stage, so what a
    task holds of it is short.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, keys, members = set(), [], []
        for token, cid, part in _runs(batches):
            if part or len(cid) > BLOCK:
                keys.append(token)
                members.append(cid)
            elif (key := cid.tobytes()) not in done:
                if len(done) >= 100_000:
                    done.clear()               # equal blocks are made one below all the same
                done.add(key)
                keys.append(None)
                members.append(cid)
            if len(members) >= 10_000:
                yield _listed(keys, members)
                keys, members = [], []
        if members:
            yield _listed(keys, members)

    found = stored(rows.filter("NOT common").select("token", "cid").repartition("token").sortWithinPartitions("token", "cid")
                   .mapInArrow(run, "token long, members array<long>"), "blocks")
    small = found.filter("token IS NULL").groupBy(F.xxhash64("members").alias("key")).agg(F.min("members").alias("members"))
    return stored(small, "blocks"), found.filter("token IS NOT NULL").select("token", F.explode("members").alias("cid")).distinct()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Each token of more than one set with its distinct sets, from sorted rows.

    More than SLICE come in pieces; the flag marks pieces.
    """
    last, held, many = None, np.zeros(0, np.int64), False

    def out():
        if many or len(held) > 1:
            yield last, held, many

    for b in batches:
        if not b.num_rows:
            continue
        token, cid = b.column("token").to_numpy(), b.column("cid").to_numpy()
        new = np.concatenate([[True], (np.diff(token) != 0) | (np.diff(cid) != 0)])
        token, cid = token[new], cid[new]
        for lo, hi in pairwise([0, *(np.flatnonzero(np.diff(token)) + 1).tolist(), len(token)]):
            own = cid[lo:hi]
            if last is None or token[lo] != last:
                yield from out()
                last, held, many = int(token[lo]), own, False
            else:
                held = np.concatenate([held, own[own != held[-1]] if len(held) else own])
            while len(held) > SLICE:
                yield last, held[:SLICE], True
                held, many = held[SLICE:], True
    yield from out()


def _listed(keys: list[int | None], members: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(m) for m in members])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(members)))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists], ["token", "members"])


class Tree:
    """A packed R-tree over points of one number of groups."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, points: np.ndarray):
        # Packing: slabs by size, within a slab by the coordinate that varies most.
        order = np.argsort(sizes, kind="stable")
        slab = FANOUT * FANOUT
        for at in range(0, len(order), slab):
            part = order[at:at + slab]
            order[at:at + slab] = part[np.argsort(points[part][:, points[part].var(0).argmax()], kind="stable")]
        self.ids, self.sizes, self.points = ids[order], sizes[order], points[order]
        self.levels = [(self.points, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > 1:
            top, least, most = self.levels[-1]
            heads = np.arange(0, len(top), FANOUT)
            self.levels.append((np.maximum.reduceat(top, heads), np.minimum.reduceat(least, heads),
                                np.maximum.reduceat(most, heads)))

    def search(self, sizes: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) offsets of all pairs whose bound reaches the needed overlap."""
        q, node = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, least, most = self.levels[depth]
            q, node = self._pruned(q, node, sizes, points, top, least, most)
            if depth:
                width = np.minimum(FANOUT, len(self.levels[depth - 1][0]) - node * FANOUT)
                q = np.repeat(q, width)
                first = np.repeat(node * FANOUT - np.concatenate([[0], np.cumsum(width)[:-1]]), width)
                node = first + np.arange(len(q))
        return q, node

    @staticmethod
    def _pruned(q, node, sizes, points, top, least, most):
        a = sizes[q]
        ok = (WHOLE * most[node] >= PART * a) & (WHOLE * a >= PART * least[node])
        q, node = q[ok], node[ok]
        keep = np.zeros(len(q), bool)
        step = max(1, (1 << 21) // points.shape[1])
        for at in range(0, len(q), step):
            x, y = q[at:at + step], node[at:at + step]
            low = np.maximum(least[y], -(-PART * sizes[x] // WHOLE))
            bound = np.minimum(points[x], top[y]).sum(1, dtype=np.int64)
            keep[at:at + step] = bound >= needed(sizes[x], low)
        return q[keep], node[keep]


def _folded(points: list[np.ndarray], m: int) -> np.ndarray:
    """Coarse points with ``m`` groups each; a full one bounds nothing."""
    m = max(8, m // 4)
    return np.stack([np.where(p == FULL, 1 << 20, p.astype(np.int32)).reshape(-1, m).sum(0, dtype=np.int32) for p in points])


def tree_join(ids, sizes, points, other=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ids that the trees let through: within one lot, or between it and ``other``.

    Sets of 4/5 similarity have sizes of the same or the next power of two, so
    there is a tree for each; the larger points are folded to the smaller's groups.
    """
    def banded(ids, sizes, points):
        band = np.array([int(n).bit_length() for n in sizes])
        return {b: np.flatnonzero(band == b) for b in np.unique(band).tolist()}

    far = other or (ids, sizes, points)
    mine, theirs = banded(ids, sizes, points), banded(*far)
    for b, own in mine.items():
        m = groups_of(1 << (b - 1))
        tree = Tree(ids[own], sizes[own], _folded([points[i] for i in own], m))
        for c in (b, b + 1):
            if c not in theirs:
                continue
            at = theirs[c]
            q, node = tree.search(far[1][at], _folded([far[2][i] for i in at], m))
            yield far[0][at][q], tree.ids[node]
    if other:   # the lower bands of the other lot against the higher of this one
        for b, at in theirs.items():
            if b + 1 in mine:
                m = groups_of(1 << (b - 1))
                tree = Tree(far[0][at], far[1][at], _folded([far[2][i] for i in at], m))
                own = mine[b + 1]
                q, node = tree.search(sizes[own], _folded([points[i] for i in own], m))
                yield ids[own][q], tree.ids[node]


def _lot(t: pa.Table):
    return (t.column("cid").to_numpy(), t.column("n").to_numpy(),
            [np.frombuffer(p, np.uint8) for p in t.column("coarse").to_pylist()])


def _emitted(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch | None:
    found = [(np.maximum(a, b), np.minimum(a, b)) for a, b in pairs]
    a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    ok = a != b
    both = np.unique(np.stack([a[ok], b[ok]], 1), axis=0)
    if len(both):
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])
    return None


def _block_pairs(blocks: DataFrame, points: DataFrame) -> DataFrame:
    """Candidate pairs of the short blocks, each through its tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["key"]):
            got = _emitted(tree_join(*_lot(t)))
            if got is not None:
                yield got

    rows = blocks.select("key", F.explode("members").alias("cid")).join(points.select("cid", "n", "coarse"), "cid")
    return rows.repartition("key").sortWithinPartitions("key").select("key", "cid", "n", "coarse") \
               .mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs whose sets reach the similarity; only the sets of pairs that pass the bound of the whole points are made and moved."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y, nx, ny in zip(*[b.column(c).to_pylist() for c in ("ta", "tb", "na", "nb")], strict=True):
                both = len(np.intersect1d(_tokens(x), _tokens(y), assume_unique=True))
                keep.append(WHOLE * both >= PART * (nx + ny - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = stored(_bounded(pairs.distinct(), points), "pairs")
    if pairs.isEmpty():
        return pairs
    ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    first = stored(points.select("cid", "text_key").join(ids, "cid"), "wanted")
    shipped = docs.sparkSession.sparkContext.broadcast(_bitmap(first.select("text_key")))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, met = shipped.value, Met()
        for b in batches:
            at = _bits(b.column("text_key").to_numpy())
            b = b.filter(pa.array((cells[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))
            b = b.filter(pa.array(met.new(b.column("text_key").to_pylist())))
            found = [h for part in lots(raw(b.column("text"))) for h in shingle_sets(part)]
            yield pa.RecordBatch.from_arrays(
                [b.column("text_key"), pa.array([set_hash(h) for h in found], pa.int64()), pa.array([len(h) for h in found], pa.int64()),
                 pa.array([_packed(h >> U(16)) for h in found], pa.binary())], ["text_key", "cid", "n", "tokens"])

    rows = _texts(docs).mapInArrow(likely, "text_key long, cid long, n long, tokens binary")
    held = stored(rows.join(first, ["text_key", "cid"]).dropDuplicates(["text_key", "cid"]).select("cid", "n", "tokens"), "held")
    side = lambda x: held.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"))
    links = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long"), "links")
    discard(pairs, first, held)
    return links


def _near(na: int, a: bytes, nb: int, b: bytes) -> bool:
    """Whether two whole points (in bytes, FULL for any number from there on) pass the summed minima."""
    if WHOLE * na < PART * nb or WHOLE * nb < PART * na:
        return False
    p, q = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    m = min(len(p), len(q))
    if len(p) != m or len(q) != m:
        p, q = (np.where(x == FULL, 1 << 20, x.astype(np.int32)).reshape(-1, m).sum(0) for x in (p, q))
    low = np.minimum(p, q)
    return bool((low >= FULL).any()) or int(low.sum(dtype=np.int64)) >= needed(na, nb)


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the summed minima of their whole points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y, nx, ny in zip(*[b.column(c).to_pylist() for c in ("pa", "pb", "na", "nb")], strict=True):
                keep.append(_near(nx, x, ny, y))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: points.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("point").alias(f"p{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b") \
                .filter((WHOLE * F.col("na") >= PART * F.col("nb")) & (WHOLE * F.col("nb") >= PART * F.col("na")))
    return near.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")


def _grouped_by(links: DataFrame) -> DataFrame:
    """``cid, component`` of the linked points."""
    return stored(components(links).withColumnRenamed("id", "cid"), "groups")


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``cid``."""
    return rows.join(groups, "cid", "left").withColumn("component", F.coalesce("component", "cid"))


def _families(rows: DataFrame) -> DataFrame:
    """``rows (token, cid)`` of large blocks with the blocks of one least set made one (stored).

    The near copies of a text share many shingles, and so many blocks of nearly
    the same sets, whose pairs would be found once for each shingle.
    """
    least = rows.groupBy("token").agg(F.min("cid").alias("family"), F.count("*").alias("n")).filter("n > 1")
    return stored(rows.join(least, "token").select(F.col("family").alias("token"), "cid").distinct(), "families")


def _lead_pairs(rows: DataFrame) -> DataFrame:
    """Per block of ``rows (token, cid, copies, component)``: its largest component's leader
    with each point outside that component."""
    parts = rows.groupBy("token", "component").agg(
        F.count("*").alias("size"), F.max_by("cid", F.struct("copies", -F.col("cid"))).alias("lead"), F.max("copies").alias("copies"))
    best = parts.groupBy("token").agg(F.max_by(F.struct("component", "lead"), F.struct("size", "copies", "lead")).alias("top"),
                                      F.count("*").alias("parts")).filter("parts > 1").select("token", "top.*")
    return rows.join(best.withColumnRenamed("component", "main"), "token").filter("component != main") \
               .select(F.greatest("cid", "lead").alias("a"), F.least("cid", "lead").alias("b")).distinct()


def _sized(rows: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their components, and each block of more than one component: its ``main`` one
    (of more than one row), that one's rows ``n``, all ``rows``, the outsiders ``out``, and the slices of both."""
    now = _labelled(rows, groups)
    parts = now.groupBy("token", "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("token").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("rows"),
                                       F.count("*").alias("parts")).filter("parts > 1") \
                 .select("token", F.when(F.col("top.n") > 1, F.col("top.component")).alias("main"), F.col("top.n").alias("n"), "rows")
    sliced = lambda n: F.greatest(F.lit(1), F.ceil(n / SLICE)).cast("int")
    sizes = sizes.withColumn("out", F.col("rows") - F.when(F.col("main").isNotNull(), F.col("n")).otherwise(0))
    return now, stored(sizes.withColumn("outs", sliced(F.col("out")))
                       .withColumn("mains", F.when(F.col("main").isNotNull(), sliced(F.col("n"))).otherwise(0)), "sizes")


def _spread(sizes: DataFrame) -> bool:
    """Whether the search across components would copy the blocks' rows more than once on average.

    Leaders make the outsiders fewer first; where the search is short as it is, it finds the same links by itself.
    """
    rows, dealt = sizes.agg(F.sum("rows"), F.sum(
        F.when((F.col("outs") == 1) & (F.col("mains") <= 1), F.col("rows"))
        .otherwise((F.col("rows") - F.col("out")) * F.col("outs") + F.col("out") * (F.col("mains") + F.col("outs"))))).first()
    return rows is not None and dealt > 2 * rows


def _common_groups(rows: DataFrame, docs: DataFrame, points: DataFrame, links: DataFrame) -> DataFrame:
    """``cid, component`` once the blocks of frequent shingles are searched too."""
    groups = _grouped_by(links)
    now, sizes = _sized(rows, groups)
    for _ in range(ROUNDS):
        if not _spread(sizes):
            break
        more = _verified(_lead_pairs(now), docs, points)
        if more.isEmpty():
            break
        links = stored(links.union(more).distinct(), "links")
        groups = _grouped_by(links)
        now, sizes = _sized(rows, groups)
    # Whatever is left across components: the rows outside each block's largest component
    # (outsiders) with its rows and with one another; slice by slice where there are many.
    each = now.select("token", "cid", "component").join(sizes.select("token", "main", "outs", "mains"), "token") \
              .withColumn("inside", F.coalesce(F.col("component") == F.col("main"), F.lit(False)))
    place = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    single = (F.col("outs") == 1) & (F.col("mains") <= 1)
    alone = each.filter(single).select("token", F.lit(2).alias("far"), F.lit(0).alias("i"), F.lit(0).alias("j"),
                                       F.col("inside").cast("int").alias("own"), "cid", "component")
    each = each.filter(~single)
    inside = each.filter("inside").withColumn("j", place("mains")).withColumn("i", every("outs")) \
                 .select("token", F.lit(1).alias("far"), "i", "j", F.lit(1).alias("own"), "cid", "component")
    outside = each.filter("NOT inside")
    across = outside.filter("mains > 0").withColumn("i", place("outs")).withColumn("j", every("mains")) \
                    .select("token", F.lit(1).alias("far"), "i", "j", F.lit(0).alias("own"), "cid", "component")
    among = outside.withColumn("own", place("outs")).withColumn("to", every("outs")) \
                   .select("token", F.lit(0).alias("far"), F.least("own", "to").alias("i"), F.greatest("own", "to").alias("j"), "own", "cid", "component")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["token", "far", "i", "j"]):
            where = dict(zip(t.column("cid").to_pylist(), t.column("component").to_pylist(), strict=True))
            if len(set(where.values())) < 2:
                continue
            own = t.column("own").to_numpy()
            lots = [_lot(t.filter(pa.array(own == k))) for k in np.unique(own).tolist()]
            i, j, far = (t.column(c)[0].as_py() for c in ("i", "j", "far"))
            if len(lots) == 1 and (far == 1 or i != j):
                continue
            found = [*tree_join(*lots[0], other=lots[1])] if len(lots) == 2 else []
            if far == 2 or len(lots) == 1:
                found += tree_join(*lots[0])
            # Whole points decide at once, so that a pair's points need not be moved.
            whole = dict(zip(t.column("cid").to_pylist(), zip(t.column("n").to_pylist(), t.column("point").to_pylist(), strict=True), strict=True))
            between = []
            for a, b in found:
                ok = np.array([where[x] != where[y] and _near(*whole[x], *whole[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)], bool)
                between.append((a[ok], b[ok]))
            got = _emitted(iter(between))
            if got is not None:
                yield got

    dealt = alone.union(inside).union(across).union(among).join(points.select("cid", "n", "coarse", "point"), "cid")
    pairs = dealt.repartition("token", "far", "i", "j").sortWithinPartitions("token", "far", "i", "j") \
                 .select("token", "far", "i", "j", "own", "cid", "n", "component", "coarse", "point").mapInArrow(run, "a long, b long")
    more = _verified(pairs, docs, points)
    return groups if more.isEmpty() else _grouped_by(links.union(more).distinct())


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The hashes of ``keys (text_key)`` as a bitmap of fixed size, joined piece by piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_bits(b.column("text_key").to_numpy()) for b in batches if b.num_rows]
        bits = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        for part in np.split(bits, np.flatnonzero(np.diff(bits >> SEGMENT)) + 1):
            if len(part):
                cells = np.zeros(1 << SEGMENT, bool)
                cells[part & ((1 << SEGMENT) - 1)] = True
                yield pa.RecordBatch.from_arrays([pa.array([int(part[0] >> SEGMENT)], pa.int32()),
                                                  pa.array([np.packbits(cells).tobytes()])], ["segment", "cells"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["segment"]):
            cells = np.bitwise_or.reduce([np.frombuffer(c, np.uint8) for c in t.column("cells").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(t.column("segment").to_numpy()[:1]), pa.array([cells.tobytes()])],
                                             ["segment", "cells"])

    out = np.zeros((1 << BITMAP - SEGMENT, 1 << SEGMENT - 3), np.uint8)
    schema = "segment int, cells binary"
    for r in keys.mapInArrow(run, schema).repartition("segment").sortWithinPartitions("segment").mapInArrow(join, schema).collect():
        out[r["segment"]] = np.frombuffer(r["cells"], np.uint8)
    return out.ravel()


def _bits(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.uint64)) >> U(64 - BITMAP)).astype(np.int64)


def _points(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid, text_key, n, copies, point, coarse`` of the sets in ``wanted (cid)``: one row each, without the sets."""
    first = sets.filter("n > 0").groupBy("cid").agg(F.min("rid").alias("rid"), F.count("*").alias("copies")) \
                .join(wanted, "cid", "left_semi")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(p, "<u2") for p in b.column("point").to_pylist()]
            small = [coarse(p).tobytes() for p in found]
            whole = [np.minimum(p, FULL).astype(np.uint8).tobytes() for p in found]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(whole, pa.binary()), pa.array(small, pa.binary())],
                                             [*b.schema.names, "coarse"])

    rows = sets.filter("n > 0").select("rid", "text_key", "n", "point").join(first, "rid").select("cid", "text_key", "n", "copies", "point")
    return stored(rows.mapInArrow(run, "cid long, text_key long, n long, copies long, point binary, coarse binary"), "points")


def similar_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id, kept.

    ``kept`` marks one row of each component: the smallest doc_id's (the first
    of repeated rows), and every row with the empty set.
    """
    found = document_sets(docs)
    sets = found.filter("rid IS NOT NULL")
    prefixes = _prefixes(docs, _frequent(found))
    blocks, large = _blocks(prefixes)
    common = _families(stored(prefixes.filter("common").select("token", "cid").union(large).distinct(), "common"))
    wanted = blocks.select(F.explode("members").alias("cid")).union(common.select("cid")).distinct()
    points = _points(sets, wanted)
    common = stored(common.join(points.select("cid", "copies"), "cid"), "common")
    # The short blocks' pairs and the first leaders' are verified together.
    pairs = _block_pairs(blocks, points).union(_lead_pairs(common.withColumn("component", F.col("cid"))))
    links = _verified(pairs, docs, points)
    group = _common_groups(common, docs, points, links)
    member = sets.select("rid", "doc_id", "text_key", "n", "cid").join(group, "cid", "left") \
                 .withColumn("component", F.coalesce("component", "cid"))
    first = member.filter("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("f"))
    return member.join(first, "component", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("f.doc_id")).alias("component_id"),
        (F.col("component").isNull() | (F.col("rid") == F.col("f.rid"))).alias("kept"))


def similarity_report(docs: DataFrame) -> DataFrame:
    return similar_documents(docs).drop("text_key")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (any columns) less all but one of each component.

    Rows are told apart by doc_id and text; of equal rows the first stays.
    """
    rows = similar_documents(docs).groupBy("doc_id", "text_key").agg(
        F.max("kept").alias("kept"), ((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("again"))
    kept = stored(rows.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"), "again"), "kept")
    marked = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_key")))
    if kept.filter("again").isEmpty():
        return marked.select(*docs.columns)
    once = marked.filter("NOT again").select(*docs.columns)
    return once.union(marked.filter("again").dropDuplicates(["kept_id", "kept_key"]).select(*docs.columns))
