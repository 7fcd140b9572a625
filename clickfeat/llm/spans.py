"""Substring dedup by sliding sentence spans (operator 1).

A text is cut to sentences (words up to one that ends in . ! ? or before a
line's end). From every sentence starts a span: the shortest run of at least
``SENTENCES`` consecutive sentences with at least ``WORDS`` words. Sentences of
more than ``LONG`` words are also cut to units, behind each word whose hash is
the least of any ``WINDOW`` consecutive words of its sentence (the last of equal
ones), so that equal words are cut alike wherever they lie; further spans are
made of units (short sentences are units themselves) in the same way. Any
passage of 50 words that two documents share holds a whole span of both.

All spans of all documents are hashed (lower-cased words, white space aside) and
joined globally; the first occurrence of a span (smallest doc_id, then row and
place) stays, and every unit that a later occurrence covers is removed. A span
of cut units that overlaps its own first occurrence leaves that one whole.

The rows of a span meet in one task, which passes on those behind the first.
Spans that a sample shows to be in many documents do not: their firsts are
aggregated on the map side and broadcast (a bounded number), so a passage in
every document makes no task larger.

Defined cases: NULL and empty texts have no sentences; NULL doc_ids come
last; a repeated row loses all sentences that spans of its first copy cover;
texts of fewer sentences or words than a span keep all; texts of any length
are read whole; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import bounded_top, raw, stored
from clickfeat.llm.hashing import Words, lots, run_hashes

SENTENCES, WORDS = 2, 12
LONG, WINDOW = 16, 8  # words of a sentence that is not cut; words with a cut behind at least one
SAMPLED, HOT_ROWS, HOT_KEPT = 64, 6400, 50_000  # documents to one sampled, rows of a hot span, hot spans
STOPS = np.frombuffer(b".!?", np.uint8)


def sentence_spans(texts: list[bytes]):
    """Per text: (unit starts, ends in code points, their sentences, span places, hashes, lengths).

    Places and lengths count units; the length of a span that is not a run of
    whole sentences alone is negative.
    """
    w = Words(texts)
    n = len(w.start)
    chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    lines = np.concatenate([[0], np.cumsum(w.data == 10)])
    if not n:
        none = np.zeros(0, np.int64)
        return [(none,) * 6 for _ in texts]
    # A sentence ends with its word, at a line's end, and with its text (texts are lines).
    last = np.isin(w.data[w.end - 1], STOPS)
    last[:-1] |= lines[w.start[1:]] > lines[w.end[:-1]]
    last[-1] = True
    closes = np.flatnonzero(last) + 1
    opens = np.concatenate([[0], closes[:-1]])
    sentence = np.repeat(np.arange(len(opens)), closes - opens)
    cut = _cut(w.hash, last, sentence, (closes - opens)[sentence] > LONG)
    unit_closes = np.flatnonzero(cut) + 1
    unit_opens = np.concatenate([[0], unit_closes[:-1]])
    start, end = _runs(opens, closes, w.cuts)
    more, upto = _runs(unit_opens, unit_closes, w.cuts)
    whole = np.full(n, -1)
    whole[start] = end
    new = whole[more] != upto
    loose = np.repeat([False, True], [len(start), new.sum()])
    start, end = np.concatenate([start, more[new]]), np.concatenate([end, upto[new]])
    order = np.argsort(start, kind="stable")
    start, end, loose = start[order], end[order], loose[order]
    h = run_hashes(w.hash, start, end).view(np.int64) ^ loose     # the two kinds meet only their own
    at = np.searchsorted(unit_opens, start)
    size = np.searchsorted(unit_closes, end) + 1 - at
    size[loose] *= -1
    begins, ends, own = chars[w.start[unit_opens]], chars[w.end[unit_closes - 1]], sentence[unit_opens]
    units, spans = np.searchsorted(unit_opens, w.cuts), np.searchsorted(start, w.cuts)
    out = []
    for k in range(len(texts)):
        lo, hi, a, b = units[k], units[k + 1], spans[k], spans[k + 1]
        base = chars[w.heads[k]]
        out.append((begins[lo:hi] - base, ends[lo:hi] - base, own[lo:hi] - own[lo:lo + 1], at[a:b] - lo, h[a:b], size[a:b]))
    return out


def _cut(words: np.ndarray, last: np.ndarray, sentence: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether a unit ends with a word; ``last``: a sentence does, ``long``: its sentence is cut."""
    cut, ahead = last.copy(), WINDOW - 1
    windows = np.flatnonzero(long[:-ahead] & (sentence[:-ahead] == sentence[ahead:]))
    if len(windows):
        each = np.lib.stride_tricks.sliding_window_view(words, WINDOW)[windows]
        cut[windows + ahead - each[:, ::-1].argmin(1)] = True
    return cut


def _runs(opens: np.ndarray, closes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the shortest run from each sentence or unit that is a span."""
    cuts = np.searchsorted(opens, texts)
    stop = np.repeat(cuts[1:], np.diff(cuts))             # per sentence: its text's end
    to = np.maximum(np.arange(len(opens)) + SENTENCES, np.searchsorted(closes, opens + WORDS) + 1)
    whole = to <= stop
    return opens[whole], closes[to[whole] - 1]


def _list(parts: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], kind))


def document_spans(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: unit places and sentences, span places, hashes and lengths; written once."""
    source = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    names = ["rid", "doc_id", *carry, "begins", "ends", "sentences", "places", "spans", "sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [x for part in lots([t or b"" for t in raw(b.column("text"))]) for x in sentence_spans(part)]
            cols = [[x[i] for x in found] for i in range(6)]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), *[b.column(c) for c in carry],
                 *[_list(c, k) for c, k in zip(cols, kinds, strict=True)]], names)

    extra = "".join(f"{c} {dict(docs.dtypes)[c]}, " for c in carry)
    schema = f"rid long, doc_id {kind}, {extra}begins array<int>, ends array<int>, " \
             "sentences array<int>, places array<int>, spans array<long>, sizes array<int>"
    return stored(source.mapInArrow(run, schema), "spans")


def _hot_spans(rows: DataFrame) -> DataFrame:
    """The hashes (at most HOT_KEPT, the commonest) of spans that many documents hold, by a sample.

    The sample decides only which way a span's rows take, not what becomes of them.
    """
    part = rows.filter(F.pmod(F.xxhash64("rid"), F.lit(SAMPLED)) == 0).select(F.explode("spans").alias("h"))
    often = part.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= HOT_ROWS // SAMPLED)
    return stored(bounded_top(often, "n", HOT_KEPT).select("h"), "hot-spans")


def repeated_sentences(rows: DataFrame) -> DataFrame:
    """``rid, gone, whole``: the units that non-first spans cover, and those that spans of whole sentences do.

    All rows of a span meet in one task, in their order, and those behind the
    first leave it at once: one exchange of short rows. The rows of hot spans
    do not move: their first occurrences are aggregated and broadcast.
    """
    # Place, kind and length in one number, so that a row stays short.
    x = F.col("s")
    place = F.shiftleft(x["places"].cast("long"), 32) + F.abs(x["sizes"]) + F.when(x["sizes"] < 0, F.lit(LOOSE)).otherwise(F.lit(0))
    each = rows.select("rid", "doc_id", F.explode(F.arrays_zip("places", "spans", "sizes")).alias("s")) \
               .select("rid", "doc_id", x["spans"].alias("h"), place.alias("place"))
    hot = _hot_spans(rows)

    def behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)                  # the present span's first row: hash, rid, place
        for b in batches:
            if not b.num_rows:
                continue
            h, rid, place = (b.column(c).to_numpy() for c in ("h", "rid", "place"))
            new = np.concatenate([[not held.shape[1] or h[0] != held[0, 0]], np.diff(h) != 0])
            firsts = np.concatenate([held, np.stack([h[new], rid[new], place[new]])], 1)
            own = np.cumsum(new) - 1 + held.shape[1]
            held = firsts[:, -1:]
            later = ~new
            yield _cover(rid[later], place[later], firsts[1, own[later]], firsts[2, own[later]])

    cold = each if hot.isEmpty() else each.join(F.broadcast(hot), "h", "left_anti")
    found = cold.repartition("h").sortWithinPartitions("h", F.col("doc_id").isNull(), "doc_id", "rid", "place") \
                .select("h", "rid", "place").mapInArrow(behind, COVER)
    if not hot.isEmpty():
        found = found.union(_behind_hot(rows, hot))

    def covered(spans):
        each = F.transform(F.collect_list(spans), lambda s: F.sequence(s["begin"], s["end"] - 1))
        return F.array_sort(F.array_distinct(F.flatten(each)))

    span = F.struct("begin", "end")
    return found.groupBy("rid").agg(covered(span).alias("gone"), covered(F.when(F.col("whole"), span)).alias("whole"))


COVER = "rid long, begin int, end int, whole boolean"
LOOSE = 1 << 31        # marks a span that is not made of whole sentences alone


def _of_hashes(b: pa.RecordBatch, hashes: np.ndarray):
    """The spans of a batch of documents that are among sorted ``hashes``: document, number of the hash, place."""
    spans = b.column("spans")
    h = spans.flatten().to_numpy()
    at = np.searchsorted(hashes, h)
    hit = np.flatnonzero(hashes[np.minimum(at, len(hashes) - 1)] == h)
    doc = np.repeat(np.arange(b.num_rows), pc.list_value_length(spans).to_numpy(zero_copy_only=False))[hit]
    place, size = (b.column(c).flatten().to_numpy()[hit].astype(np.int64) for c in ("places", "sizes"))
    return doc, at[hit], (place << 32) + np.abs(size) + np.where(size < 0, LOOSE, 0)


def _behind_hot(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """What the rows of hot spans cover behind their first ones; no row is moved.

    Hashes and firsts (at most HOT_KEPT of each) are broadcast.
    """
    sc, kind = rows.sparkSession.sparkContext, dict(rows.dtypes)["doc_id"]
    hashes = np.sort(np.array([r["h"] for r in hot.collect()], np.int64))
    shipped = sc.broadcast(hashes)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, at, place = _of_hashes(b, shipped.value)
            ids = b.column("doc_id").to_pylist()
            rid = b.column("rid").to_numpy()
            rank = np.zeros(b.num_rows, np.int64)
            rank[sorted(range(b.num_rows), key=lambda k: (ids[k] is None, ids[k] if ids[k] is not None else 0, rid[k]))] = np.arange(b.num_rows)
            order = np.lexsort((place, rank[doc], at))
            order = order[np.concatenate([[True], np.diff(at[order]) != 0])[:len(order)]]
            yield pa.RecordBatch.from_arrays([pa.array(at[order]), b.column("doc_id").take(pa.array(doc[order])),
                                              pa.array(rid[doc[order]]), pa.array(place[order])], ["k", "doc_id", "rid", "place"])

    source = rows.select("rid", "doc_id", "places", "spans", "sizes")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rid", "place")
    firsts = source.mapInArrow(least, f"k long, doc_id {kind}, rid long, place long").groupBy("k").agg(F.min(order).alias("f")) \
                   .select("k", "f.rid", "f.place").collect()
    first = np.zeros((2, len(hashes)), np.int64)
    for r in firsts:
        first[:, r["k"]] = r["rid"], r["place"]
    known = sc.broadcast(first)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, at, place = _of_hashes(b, shipped.value)
            rid = b.column("rid").to_numpy()[doc]
            first_rid, first_place = known.value[:, at]
            later = (rid != first_rid) | (place != first_place)
            yield _cover(rid[later], place[later], first_rid[later], first_place[later])

    return source.mapInArrow(beside, COVER)


def _cover(rid, place, first_rid, first_place) -> pa.RecordBatch:
    """The units that later rows of a span cover; a loose one leaves its own first occurrence whole."""
    low, loose = LOOSE - 1, (place & LOOSE) != 0
    begin, end = place >> 32, (place >> 32) + (place & low)
    first_end = (first_place >> 32) + (first_place & low)
    begin = np.where(loose & (rid == first_rid), np.maximum(begin, first_end), begin)
    some = begin < end
    return pa.RecordBatch.from_arrays(
        [pa.array(rid[some]), pa.array(begin[some].astype(np.int32)), pa.array(end[some].astype(np.int32)), pa.array(~loose[some])],
        ["rid", "begin", "end", "whole"])


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``gone`` and the removed places as ``cut`` (stretches of adjoining units); ``n_removed``: sentences of repeated sentence spans."""
    both = rows.drop("places", "spans", "sizes").join(repeated_sentences(rows), "rid", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            out, removed = [], []
            for gone, begins, ends, own, whole in zip(
                    *[b.column(c).to_pylist() for c in ("gone", "begins", "ends", "sentences", "whole")], strict=True):
                cut: list[dict] = []
                for k, i in enumerate(gone or ()):
                    if k and gone[k - 1] == i - 1:
                        cut[-1]["end"] = ends[i]
                    else:
                        cut.append({"start": begins[i], "end": ends[i]})
                out.append(cut)
                removed.append(len({own[i] for i in whole or ()}))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind), pa.array(removed, pa.int64())],
                                             [*b.schema.names, "cut", "n_removed"])

    schema = both.withColumn("cut", F.lit(None).cast("array<struct<start:int,end:int>>")) \
                 .withColumn("n_removed", F.lit(None).cast("long")).schema
    return both.mapInArrow(run, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text without the units of repeated spans, and the places cut from it."""
    rows = _marked(document_spans(docs, carry=("text",)))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, cut in zip(b.column("text").to_pylist(), b.column("cut").to_pylist(), strict=True):
                parts, at = [], 0
                for c in cut or ():
                    parts.append(text[at:c["start"]])
                    at = c["end"]
                texts.append("".join([*parts, text[at:]]).strip() if cut else text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), b.column("cut")],
                                             ["doc_id", "text", "cut"])

    return rows.select("doc_id", "text", "cut").mapInArrow(
        run, f"doc_id {kind}, text string, cut array<struct<start:int,end:int>>")


def span_report(docs: DataFrame) -> DataFrame:
    """doc_id, sentences, those that repeated sentence spans cover, removed characters, removed places as start:end.

    Characters and places count cut units too.
    """
    rows = _marked(document_spans(docs))
    size = F.aggregate("cut", F.lit(0), lambda n, c: n + c["end"] - c["start"])
    return rows.select(
        "doc_id", F.coalesce(F.array_max("sentences") + 1, F.lit(0)).cast("long").alias("n_sentences"),
        "n_removed", size.cast("long").alias("removed_chars"),
        F.concat_ws(",", F.transform("cut", lambda c: F.concat_ws(":", c["start"].cast("string"), c["end"].cast("string")))).alias("removed"))
