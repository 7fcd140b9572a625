"""LM scoring by subword lattice likelihood (operator 3).

A word's lattice holds every segmentation of the marked word into pieces of
an existing unigram vocabulary (a SentencePiece file; characters no piece
holds go to byte pieces) and one edge for the whole word. A forward recursion
sums all segmentations, in log space where the sum could leave the range of a
double. Since pieces never cross a word mark, the
probability of a text is the product over its words and one end.

Learned from the training rows, over all of them: the piece weights (from the
vocabulary's own ranks, re-estimated by expected piece counts of all word
types, first together and then per class), and per class of text the whole-word edges (absolute discounting: what
the discount frees goes to the piece lattice) and the end. The classes are the
``CLASSES`` most frequent languages of the training rows, the rest together;
a text's class is never read when scoring: its probability ``score`` is the marginal
over classes and segmentations. The whole-word edges' share is learned: it is
what the discount, estimated from the words met once and twice, leaves of their counts.
``lattice_score`` is the text's probability by the pieces alone, all classes together.

Counts of words are joined, never collected: words of up to ``SHORT`` bytes
among the (at most ``COMMON``) most frequent are broadcast (a bounded table), all others
are joined by key with their own share of the counts.

Defined cases: a NULL text is empty (one token, the end); NULL doc_ids hash as
the empty text; repeated rows count and are scored each; without training rows
the base score is 0 and the pieces' initial weights decide; texts and words of
any length are scored whole; an empty table gives no rows. Only doc_id, text and lang are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from copy import copy
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import bounded_top, crc_mod, stored
from clickfeat.llm.pieces import MARK, MODEL, Edges, Vocabulary, load_vocabulary

CLASSES = 7           # languages with word edges of their own; the rest share one more
COMMON, SHORT = 100_000, 64
ROUNDS = 3            # re-estimations of the piece weights per class
PRIOR = 10.0          # its prior, in pieces
FLUSH = 300_000       # distinct words a task gathers before passing them on
AT_ONCE = 1 << 21     # bytes of texts cut into words together
TINY = 1e-200         # sums below are taken again in log space
END = b"\n"           # stands for the end of a text; no word holds it


class Lattice(Edges):
    """The recursions over a batch of marked words.

    ``weights`` has a row per piece and a column per class (natural logs).
    The edges of a word are found once and kept as one list, by the place where
    they end in the word: twice the piece (or, below zero, the character that
    goes to byte pieces), plus one where the place is the next. Each place of
    a word ends an edge, that of its last character at least.
    """

    def __init__(self, v: Vocabulary, weights: np.ndarray):
        super().__init__(v)
        self.w, self.p = weights, np.exp(weights)
        self.length = np.array([len(p) for p in v.pieces], np.int64)

    def find(self, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes of the marked words, where each one's edges end in their list, and the list."""
        marked = [MARK + w.decode("utf-8", "replace").replace(MARK, "\ufffd") for w in batch]
        self.load(marked)
        code = self.row.copy()
        lone = code >= self.size
        joined = "\n".join(marked)
        code[lone] = [-1 - ord(joined[p]) for p in self.start[lone].tolist()]
        order = np.argsort(self.end, kind="stable")
        end = self.end[order]
        ends = np.searchsorted(end, np.append(self.first, self.nodes), "right")
        return self.last - self.first, ends, (code[order] * 2 + (np.diff(end, prepend=-1) > 0)).astype("<i4")

    def lay(self, sizes: np.ndarray, counts: np.ndarray, kept: np.ndarray) -> None:
        """Lay out the kept edges (``counts`` a word, end to end) of a batch of words."""
        self.first = np.cumsum(sizes + 1) - sizes - 1
        self.last = self.first + sizes
        self.nodes = int((sizes + 1).sum())
        self.word = np.repeat(np.arange(len(sizes)), counts)
        code = (kept >> 1).astype(np.int64)
        lone = code < 0
        self.to_at = np.cumsum(kept & 1, dtype=np.int64) - (self.first - np.arange(len(sizes)))[self.word]
        chars, which = np.unique(code[lone], return_inverse=True)
        self.spelled = [self.spell(chr(-1 - c)) for c in chars.tolist()]
        self.from_at = self.to_at - np.where(lone, 1, self.length[np.where(lone, 0, code)])
        self.row = code
        self.row[lone] = self.size + which
        self.start, self.end = self.first[self.word] + self.from_at, self.first[self.word] + self.to_at
        self.rows, self.chances = self.w, self.p
        if self.spelled:
            more = np.array([self.w[ids].sum(0) for ids in self.spelled])
            self.rows, self.chances = np.vstack([self.w, more]), np.vstack([self.p, np.exp(more)])

    def take(self, batch: list[bytes]) -> None:
        """Find and lay out the edges of a batch of words."""
        sizes, ends, kept = self.find(batch)
        self.lay(sizes, np.diff(ends), kept)

    def pick(self, words: np.ndarray) -> Lattice:
        """The lattices of ``words`` only (again for each time that one is named)."""
        if len(words) == len(self.first) and (np.diff(words) == 1).all():
            return self
        part = copy(self)
        counts = np.bincount(self.word, minlength=len(self.first))
        heads, sizes = np.cumsum(counts) - counts, (self.last - self.first)[words]
        counts = counts[words]
        each = np.repeat(heads[words] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        part.first = np.cumsum(sizes + 1) - sizes - 1
        part.last = part.first + sizes
        part.nodes = int((sizes + 1).sum())
        part.word = np.repeat(np.arange(len(words)), counts)
        part.from_at, part.to_at, part.row = self.from_at[each], self.to_at[each], self.row[each]
        first = part.first[part.word]
        part.start, part.end = first + part.from_at, first + part.to_at
        return part

    def _sweep(self, terms: np.ndarray, forward: bool, logs: bool) -> np.ndarray:
        """Sums over all paths from the words' first nodes (or back from their last), place by place.

        ``terms`` are the edges' weights: one each, or one for each class.
        """
        source, target, place, begin = (self.start, self.end, self.to_at, self.first) if forward else \
            (self.end, self.start, self.from_at, self.last)
        sums = np.full((self.nodes, *terms.shape[1:]), -np.inf if logs else 0.0)
        sums[begin] = 0.0 if logs else 1.0
        # Small numbers are sorted in one pass; the words stay in order, so each target's edges are together.
        order = np.argsort(place.astype(np.uint16) if len(place) and place.max() < 1 << 16 else place, kind="stable")
        src, dst, weight, pos = source[order], target[order], terms[order], place[order]
        heads = np.flatnonzero(np.diff(dst, prepend=-1))
        aims = dst[heads]
        cuts = np.searchsorted(pos, np.arange(pos[0], pos[-1] + 2)) if len(pos) else np.zeros(1, int)
        rounds = list(zip(pairwise(cuts.tolist()), pairwise(np.searchsorted(heads, cuts).tolist()), strict=True))
        for (lo, hi), (one, end) in rounds if forward else rounds[::-1]:
            if lo == hi:
                continue
            at = heads[one:end] - lo
            if logs:
                own = sums[src[lo:hi]] + weight[lo:hi]
                top = np.maximum(np.maximum.reduceat(own, at), -1e300)
                total = np.add.reduceat(np.exp(own - np.repeat(top, np.diff(np.append(at, hi - lo)), 0)), at)
                with np.errstate(divide="ignore"):
                    sums[aims[one:end]] = top + np.log(total)
            else:
                sums[aims[one:end]] = np.add.reduceat(sums[src[lo:hi]] * weight[lo:hi], at)
        return sums

    def marginals(self) -> np.ndarray:
        """Log probability of each word (rows) in each class."""
        total = self._sweep(self.chances[self.row], True, False)[self.last]
        small = np.flatnonzero((total < TINY).any(1))
        total[small] = 1.0
        out = np.log(total)
        if len(small):
            part = self.pick(small)
            out[small] = part._sweep(part.rows[part.row], True, True)[part.last]
        return out

    def expected(self, classes: np.ndarray) -> np.ndarray:
        """Expected piece counts per class; ``classes`` says which words (rows) are in which class (columns)."""
        words, kinds = np.nonzero(classes)
        size, width = self.w.shape
        if not len(words):
            return np.zeros((size, width))
        part = self.pick(words)
        at = part.row * width + kinds[part.word]
        terms = self.chances.ravel()[at]
        a, b = part._sweep(terms, True, False), part._sweep(terms, False, False)
        total = a[part.last]
        small = np.flatnonzero(total < TINY)
        total[small] = np.inf
        out = np.bincount(at, a[part.start] * terms * b[part.end] / total[part.word], len(self.rows) * width)
        if len(small):
            part = part.pick(small)
            at = part.row * width + kinds[small][part.word]
            terms = self.rows.ravel()[at]
            a, b = part._sweep(terms, True, True), part._sweep(terms, False, True)
            out += np.bincount(at, np.exp(a[part.start] + terms + b[part.end] - a[part.last][part.word]), len(out))
        out = out.reshape(-1, width)
        counts = out[:size]
        for ids, n in zip(self.spelled, out[size:], strict=True):
            np.add.at(counts, ids, n)
        return counts


def initial_weights(v: Vocabulary) -> np.ndarray:
    """Zipf's law over the vocabulary's score order; the byte pieces come last (one column)."""
    order = sorted((i for i, k in enumerate(v.kinds) if k == "p"), key=lambda i: -v.scores[i])
    order += [i for i, k in enumerate(v.kinds) if k == "b"]
    mass = np.zeros((len(v.pieces), 1))
    mass[order, 0] = 1.0 / (10.0 + np.arange(len(order)))
    return _logs(mass)


def _logs(mass: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(mass / mass.sum(0))


def _cut(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """The lower-cased words of texts, about ``AT_ONCE`` bytes of texts at a time.

    Gives the first row and the one after the last, the distinct words, and of each
    word its place among them and its row (counted from the first).
    """
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    lots = np.flatnonzero(np.diff(np.cumsum(size) // AT_ONCE)) + 1
    for lo, hi in pairwise([0, *lots.tolist(), len(column)]):
        found = pc.ascii_split_whitespace(pc.ascii_lower(column.slice(lo, hi - lo)))
        row = np.repeat(np.arange(hi - lo), pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
        found = found.flatten().cast(pa.binary())
        real = pc.greater(pc.binary_length(found), 0)       # white space at a text's ends leaves empty ones
        found, row = found.filter(real).dictionary_encode(), row[real.to_numpy(zero_copy_only=False)]
        yield lo, hi, found.dictionary, found.indices.to_numpy().astype(np.int64), row


def word_counts(docs: DataFrame, held: str, group: str, groups: int) -> DataFrame:
    """``word, t0..tn``: how often each word of all rows is in training rows of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("k", pa.int32()), ("n", pa.int64())])
        kept = schema.empty_table()

        def merged() -> pa.Table:
            sums = kept.group_by(["word", "k"], use_threads=False).aggregate([("n", "sum")])
            return pa.table([sums[c].combine_chunks() for c in ("word", "k", "n_sum")], schema=schema)

        for b in batches:
            kinds = np.where(b.column("held").to_numpy(zero_copy_only=False), groups, b.column("g").to_numpy(zero_copy_only=False))
            for lo, hi, own, code, row in _cut(b.column("text")):
                k = kinds[lo:hi].astype(np.int64)       # ``groups``: held-out rows
                n = np.bincount(k[row] * len(own) + code, minlength=(groups + 1) * len(own))
                at = np.flatnonzero(n)
                which, word = np.divmod(at, max(len(own), 1))
                ends = np.bincount(k, minlength=groups + 1)
                some = np.flatnonzero(ends)
                met = [own.take(pa.array(word)), pa.array(which.astype(np.int32)), pa.array(n[at])]
                one = [pa.array([END] * len(some), pa.binary()), pa.array(some.astype(np.int32)), pa.array(ends[some])]
                kept = pa.concat_tables([kept, pa.table(met, schema=schema), pa.table(one, schema=schema)])
                if len(kept) >= 2 * FLUSH:
                    kept = merged()
                    if len(kept) >= FLUSH:
                        yield from kept.to_batches()
                        kept = schema.empty_table()
        yield from merged().to_batches()

    rows = docs.select("text", F.col(held).alias("held"), F.col(group).alias("g")) \
               .mapInArrow(run, "word binary, k int, n long")
    return rows.groupBy("word").agg(
        *[F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"t{k}") for k in range(groups)])


EDGES = ["size", "edges"]


def _with_edges(counts: DataFrame, v: Vocabulary) -> DataFrame:
    """``counts`` with the edges of each word's lattice (none for the end), which all later passes use."""
    shipped = counts.sparkSession.sparkContext.broadcast(tuple(v))
    schema = counts.withColumns({"size": F.lit(0), "edges": F.lit(b"")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Lattice(Vocabulary(*shipped.value), np.zeros((0, 1)))
        for b in batches:
            if b.num_rows:
                sizes, ends, kept = model.find([w if w != END else b"" for w in b.column("word").to_pylist()])
                kept = pa.Array.from_buffers(pa.binary(), len(sizes), [None, *map(pa.py_buffer, [(4 * ends).astype(np.int32), kept])])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes.astype(np.int32)), kept], [*b.schema.names, *EDGES])

    return counts.mapInArrow(run, schema)


def _taken(model: Lattice, b: pa.RecordBatch) -> None:
    edges = b.column("edges")
    _, ends, data = edges.buffers()
    ends = np.frombuffer(ends, np.int32)[edges.offset:edges.offset + len(edges) + 1]
    model.lay(b.column("size").to_numpy().astype(np.int64), np.diff(ends) // 4, np.frombuffer(data[ends[0]:ends[-1]], "<i4"))


def _reestimated(counts: DataFrame, v: Vocabulary, start: np.ndarray, shares: list[str]) -> np.ndarray:
    """Expected piece counts of all word types, one column for each of ``shares``.

    ``shares`` are columns of ``counts``; a type counts once where it is above 0,
    and is swept only there.
    """
    if start.shape[1] != len(shares):
        start = np.repeat(start, len(shares), 1)
    shipped = counts.sparkSession.sparkContext.broadcast((tuple(v), start))
    names = [f"n{k}" for k in range(len(shares))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = shipped.value
        model, seen = Lattice(Vocabulary(*v), w), np.zeros(w.shape)
        for b in batches:
            if b.num_rows:
                _taken(model, b)
                seen += model.expected(np.stack([b.column(s).to_numpy() > 0 for s in shares], 1))
        hit = np.flatnonzero(seen.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), *map(pa.array, seen[hit].T)], ["i", *names])

    # At most one row a piece comes back.
    rows = counts.select(*shares, *EDGES) \
                 .mapInArrow(run, "i int, " + ", ".join(f"{n} double" for n in names)) \
                 .groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).collect()
    mass = np.exp(start) * PRIOR        # what the round began with stays as a small prior
    for r in rows:
        mass[r["i"]] += r[1:]
    return _logs(mass)


def _with_marginals(counts: DataFrame, v: Vocabulary, weights: np.ndarray) -> DataFrame:
    """``counts`` (less the edges) with the piece lattice's log probability of each word in each class."""
    shipped = counts.sparkSession.sparkContext.broadcast((tuple(v), weights))
    names = [f"s{k}" for k in range(weights.shape[1])]
    rest = [c for c in counts.columns if c not in EDGES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = shipped.value
        model = Lattice(Vocabulary(*v), w)
        for b in batches:
            if b.num_rows:
                _taken(model, b)
                subs = model.marginals().astype(np.float32)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], *map(pa.array, subs.T)], [*rest, *names])

    return counts.mapInArrow(run, counts.select(*rest, *[F.lit(0.0).cast("float").alias(n) for n in names]).schema)


def lattice_scores(docs: DataFrame, held_out, vocabulary: str = MODEL) -> DataFrame:
    """Base and lattice scores of every row (columns as in the module's query).

    ``held_out`` is a boolean Column; rows where it is true teach nothing.
    """
    spark = docs.sparkSession
    v = load_vocabulary(vocabulary)
    source = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                         F.coalesce(held_out, F.lit(False)).alias("held"))
    langs = [r["lang"] for r in source.filter("NOT held").groupBy("lang").count()
             .orderBy(F.desc("count"), "lang").limit(CLASSES).collect()]
    groups = len(langs) + 1
    index = F.coalesce(*[F.when(F.col("lang") == x, k) for k, x in enumerate(langs)], F.lit(len(langs)))
    source = source.withColumn("g", index)

    ts = [f"t{k}" for k in range(groups)]
    total = sum(F.col(t) for t in ts)
    counts = stored(_with_edges(word_counts(source, "held", "g", groups).withColumn("c", total), v), "lm-counts")
    is_end = F.col("word") == F.lit(END)
    sums = counts.agg(
        F.sum("c").alias("N"), F.sum((F.col("c") > 0).cast("long")).alias("V"),
        F.sum(((F.col("c") == 1) & ~is_end).cast("long")).alias("n1"),
        F.sum(((F.col("c") == 2) & ~is_end).cast("long")).alias("n2"),
        *[F.sum(F.when(~is_end, F.col(t))).alias(f"N{k}") for k, t in enumerate(ts)],
        *[F.sum((~is_end & (F.col(t) > 0)).cast("long")).alias(f"V{k}") for k, t in enumerate(ts)],
        *[F.sum(F.when(is_end, F.col(t))).alias(f"D{k}") for k, t in enumerate(ts)]).first()
    s = {k: x or 0 for k, x in sums.asDict().items()}
    n_train, log_base = s["N"], math.log10(s["N"] + s["V"] + 1)
    discount = s["n1"] / (s["n1"] + 2 * s["n2"]) if s["n1"] and s["n2"] else 0.5
    per = [(s[f"N{k}"], s[f"V{k}"], s[f"D{k}"]) for k in range(groups)]
    all_docs = sum(d for _, _, d in per)

    types = counts.filter((F.col("c") > 0) & ~is_end)
    pooled = weights = _reestimated(types, v, initial_weights(v), ["c"])
    for _ in range(ROUNDS):
        weights = _reestimated(types, v, weights, ts)
    words_table = stored(_with_marginals(counts.filter(~is_end), v, np.hstack([weights, pooled])), "lm-words")

    # A word's log probability in class k, as a SQL expression over its row.
    logs = []
    for k, (n, kinds, d) in enumerate(per):
        sub = F.col(f"s{k}").cast("double")
        back = math.log(discount * kinds / n) if n else 0.0
        p = F.exp(sub + back)
        if n:
            p += F.greatest(F.col(f"t{k}") - F.lit(discount), F.lit(0.0)) / n
        word = F.when(p > 1e-290, F.log(p)).otherwise(sub + back)
        logs.append((word + math.log1p(-(d + 0.5) / (n + d + 1.0))).alias(f"l{k}"))
    # The pieces alone, of all classes together: the lattice without whole-word edges.
    alone = F.col(f"s{groups}").cast("double") + math.log1p(-(all_docs + 0.5) / (n_train + 1.0))
    shared = words_table.select("word", "c", (F.log10(F.col("c") + 1.0) - log_base).alias("b"), *logs, alone.alias("p"))

    ends = [math.log((d + 0.5) / (n + d + 1.0)) for n, _, d in per]
    prior = [math.log((d + 0.01) / (all_docs + 0.01 * groups)) for _, _, d in per]
    common = bounded_top(shared.filter(F.length("word") <= SHORT), "c", COMMON).toPandas()
    end_base = math.log10(all_docs + 1) - log_base
    shipped = spark.sparkContext.broadcast((
        [bytes(x) for x in common["word"]], common.drop(columns=["word", "c"]).to_numpy(float)))

    # First the common words of each row; the others stay as (word, n).
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts = shipped.value
        common = pa.array(names, pa.binary())
        parts = np.vstack([parts, np.zeros(groups + 2)]).T.copy()   # the last: a word that is not common
        for b in batches:
            sizes, known = np.zeros((2, b.num_rows), np.int64)
            sums, each = np.zeros((b.num_rows, groups + 2)), np.zeros(b.num_rows, np.int64)
            rare, times = [pa.array([], pa.binary())], [np.zeros(0, np.int64)]
            for lo, hi, own, code, row in _cut(b.column("text")):
                place = pc.fill_null(pc.index_in(own, common), len(names)).to_numpy(zero_copy_only=False)
                met = (place < len(names))[code]
                sizes[lo:hi], known[lo:hi] = (np.bincount(r, minlength=hi - lo) for r in (row, row[met]))
                for k, part in enumerate(parts):
                    sums[lo:hi, k] = np.bincount(row, part[place][code], hi - lo)
                pairs, n = np.unique(row[~met] * len(own) + code[~met], return_counts=True)
                which, word = np.divmod(pairs, max(len(own), 1))
                each[lo:hi] = np.bincount(which, minlength=hi - lo)
                rare.append(own.take(pa.array(word)))
                times.append(n)
            others = pa.StructArray.from_arrays([pa.concat_arrays(rare), pa.array(np.concatenate(times))], ["word", "n"])
            cuts = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), b.column("held"), pa.array(sizes + 1), pa.array(known),
                 pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (groups + 2)), pa.array(sums.ravel())),
                 pa.ListArray.from_arrays(pa.array(cuts), others)],
                ["rid", "doc_id", "held", "n_tokens", "known", "sums", "rare"])

    numbered = source.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held", "text")
    kind = dict(source.dtypes)["doc_id"]
    first = stored(numbered.mapInArrow(
        run, f"rid long, doc_id {kind}, held boolean, n_tokens long, known long, sums array<double>, "
             "rare array<struct<word:binary,n:long>>"), "lm-rows")

    # Then the others, by key.
    rare = first.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", "r.n")
    n = F.col("n")
    rest = rare.join(shared, "word").groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, n).otherwise(0)).alias("rare_known"), F.sum(n * F.col("b")).alias("rare_base"),
        *[F.sum(n * F.col(f"l{k}")).alias(f"r{k}") for k in range(groups)], F.sum(n * F.col("p")).alias("rare_alone"))
    both = first.drop("rare").join(rest, "rid", "left")
    sums = F.col("sums")
    part = [F.lit(prior[k] + ends[k]) + sums[k + 1] + F.coalesce(F.col(f"r{k}"), F.lit(0.0)) for k in range(groups)]
    top = F.greatest(*part) if groups > 1 else part[0]
    marginal = top + F.log(sum(F.exp(p - top) for p in part))
    return both.select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + (1 if all_docs else 0)).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (sums[0] + F.coalesce("rare_base", F.lit(0.0)) + end_base).alias("base_score"),
        (marginal / math.log(10)).alias("score"),
        ((sums[groups + 1] + F.coalesce("rare_alone", F.lit(0.0)) + math.log((all_docs + 0.5) / (n_train + 1.0)))
         / math.log(10)).alias("lattice_score"))


def score_documents(docs: DataFrame) -> DataFrame:
    """Every row scored; rows whose crc32 of the doc_id's text leaves 2 modulo 7 are held out."""
    return lattice_scores(docs, crc_mod("doc_id", 7) == 2)
