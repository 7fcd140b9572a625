"""SentencePiece encoding and decoding (operator 9).

A text becomes piece ids by the unigram rule: of all segmentations into
vocabulary pieces the one of highest summed score. An Aho-Corasick automaton
over the pieces drives a single pass: at each position its output links yield
the pieces ending there (those of one character are looked up in a table), and each relaxes the best score of that position (the
words of a batch side by side). White space is the piece mark U+2581, one mark is put
before the text, and a character no piece holds falls back to its UTF-8 bytes.
The model file is the caller's (never trained here); its scores are used as
they are. Equal scores keep the longer last piece.

No piece continues past a mark or holds a line feed (checked on loading), so
the pass restarts at each word and its result may be kept per word: each task
keeps a bounded memory of words it has met; when it is full, those not met since
it was last full are dropped.

Defined cases: NULL text gives NULL ids and decodes to NULL; the empty text
gives no ids; a literal U+2581 goes to bytes, so decoding is exact for every
text; texts of any length are encoded whole; repeated rows are encoded each; an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
KEPT_BYTES, KEPT_LENGTH = 24 << 20, 48  # a task's memory of words (half of it older ones), and the longest word kept
WORD_BYTES = 150                        # of a kept word beside its characters and ids, about
AT_ONCE = 1 << 20                       # characters of texts cut together
NEW_AT_ONCE = 1 << 17                   # characters of new words segmented together
IDS_AT_ONCE = 1 << 18                   # ids decoded together
MAX_VOCABULARY = 1_000_000              # pieces shipped to tasks, at most


class Vocabulary(NamedTuple):
    """Pieces by id with their scores; ``kinds``: p piece, b byte, x neither."""

    pieces: list[str]
    scores: list[float]
    kinds: str


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file (read on the driver)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    if n > MAX_VOCABULARY:
        raise ValueError(f"vocabulary of {n} pieces exceeds {MAX_VOCABULARY}")
    kinds = "".join("b" if m.is_byte(i) else "x" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i)
                    else "p" for i in range(n))
    return Vocabulary([m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)], kinds)


class Edges:
    """The lattice edges of a batch of marked words, by one automaton pass.

    The words are laid end to end with one separator each, so that character
    positions serve as lattice nodes. After ``load``: ``start``, ``end`` nodes
    and ``row`` of every edge, where rows from ``size`` on are characters
    without a piece of their own (``spelled`` has their byte pieces);
    ``from_at`` and ``to_at`` are the nodes' places in their word ``word``;
    ``first`` and ``last`` are the end nodes of each word.
    """

    def __init__(self, v: Vocabulary):
        normal = [i for i, k in enumerate(v.kinds) if k == "p"]
        if any(MARK in v.pieces[i].lstrip(MARK) or "\n" in v.pieces[i] for i in normal):
            raise ValueError("a piece continues past a word mark")
        self.size = len(v.pieces)
        # Pieces of one character are looked up by their code point, which takes no step of Python each.
        ones = sorted((ord(v.pieces[i]), i) for i in normal if len(v.pieces[i]) == 1)
        self.chars, self.single = np.array([*ones, (0x110000, -1)], np.int64).T.copy()
        self.auto = ahocorasick.Automaton()
        for i in normal:
            if len(v.pieces[i]) > 1:
                self.auto.add_word(v.pieces[i], (i << 16) | len(v.pieces[i]))
        self.auto.make_automaton()
        self.bytes = np.full(256, -1, np.int64)
        for i, k in enumerate(v.kinds):
            if k == "b":
                self.bytes[int(v.pieces[i][3:5], 16)] = i
        if (self.bytes < 0).any():
            raise ValueError("the vocabulary lacks byte pieces")

    def spell(self, char: str) -> np.ndarray:
        return self.bytes[list(char.encode("utf-8", "surrogatepass"))]

    def load(self, marked: list[str]) -> None:
        joined = "\n".join(marked)
        sizes = np.array([len(m) for m in marked], np.int64)
        self.first = np.cumsum(sizes + 1) - sizes - 1
        self.last = self.first + sizes
        at = np.fromiter(self.auto.iter(joined) if len(self.auto) else (), "i8,i8")
        end, row, size = at["f0"] + 1, at["f1"] >> 16, at["f1"] & 0xFFFF
        point = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        near = np.searchsorted(self.chars, point)
        known = self.chars[near] == point
        one = np.flatnonzero(known)
        # Characters that no single-character piece holds: one edge of byte pieces each.
        known[self.last[:-1]] = True
        lone = np.flatnonzero(~known)
        self.spelled = [self.spell(joined[p]) for p in lone.tolist()]
        # In the order of the automaton's pass: by end, of one end the longer first.
        end, start = np.concatenate([end, one + 1]), np.concatenate([end - size, one])
        order = np.argsort((end << 16) - (end - start), kind="stable")
        self.start = np.concatenate([start[order], lone])
        self.end = np.concatenate([end[order], lone + 1])
        self.row = np.concatenate([np.concatenate([row, self.single[near[one]]])[order], self.size + np.arange(len(lone))])
        home = np.repeat(self.first, sizes + 1)
        self.from_at, self.to_at = self.start - home[self.start], self.end - home[self.start]
        self.word = np.repeat(np.arange(len(marked)), sizes + 1)[self.start]
        self.nodes = len(joined) + 1


class Pieces:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, v: Vocabulary):
        self.edges = Edges(v)
        normal = [i for i, k in enumerate(v.kinds) if k == "p"]
        self.scores = np.array(v.scores)
        self.unknown = min(v.scores[i] for i in normal) - 10.0
        self.chunks = re.compile(f" *[^ \n{MARK}]+| +|\n|{MARK}")
        self.kept = {c: self.edges.spell(c).astype("<i4").tobytes() for c in ("\n", MARK)}
        self.older = {}        # words kept before; those met again are kept on
        self.held = 0          # bytes of the kept words, about, less the older ones'
        # Decoding: the bytes of each piece, end to end.
        spelled = [bytes([int(p[3:5], 16)]) if k == "b" else p.replace(MARK, " ").encode() if k == "p" else b""
                   for p, k in zip(v.pieces, v.kinds, strict=True)]
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.place = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)

    def viterbi(self, marked: list[str]) -> list[bytes]:
        """The best segmentation of each marked word, as little-endian 32-bit ids."""
        g = self.edges
        g.load(marked)
        rows = np.concatenate([self.scores, np.full(len(g.spelled), self.unknown)])
        best, back = np.full(g.nodes, -np.inf), np.full(g.nodes, -1)
        best[g.first] = 0.0
        order = np.lexsort((g.start, g.end, g.to_at))   # of equal scores the longer piece comes first
        start, end, score, pos = g.start[order], g.end[order], rows[g.row[order]], g.to_at[order]
        cuts = [0, *(np.flatnonzero(np.diff(pos)) + 1).tolist(), len(order)]
        for lo, hi in pairwise(cuts):
            terms = best[start[lo:hi]] + score[lo:hi]
            heads = np.flatnonzero(np.concatenate([[True], np.diff(end[lo:hi]) != 0]))
            top = np.maximum.reduceat(terms, heads)
            first = np.where(terms == np.repeat(top, np.diff(np.append(heads, hi - lo))), np.arange(lo, hi), len(order))
            at = end[lo:hi][heads]
            best[at], back[at] = top, np.minimum.reduceat(first, heads)
        # All words walk back together; rounds end with the longest.
        node, live, steps = g.last.copy(), np.flatnonzero(g.last > g.first), []
        while len(live):
            edge = back[node[live]]
            steps.append((live, g.row[order[edge]]))
            node[live] = start[edge]
            live = live[node[live] > g.first[live]]
        if not steps:
            return [b""] * len(marked)
        word, row = (np.concatenate(x) for x in zip(*steps, strict=True))
        back_to_front = np.concatenate([np.full(len(w), -k) for k, (w, _) in enumerate(steps)])
        order = np.lexsort((back_to_front, word))
        word, row = word[order], row[order]
        lone = row >= self.edges.size
        if lone.any():
            size = np.ones(len(row), np.int64)
            size[lone] = [len(g.spelled[r - self.edges.size]) for r in row[lone].tolist()]
            ids = np.repeat(row, size)
            ids[np.repeat(lone, size)] = np.concatenate([g.spelled[r - self.edges.size] for r in row[lone].tolist()])
            word, row = np.repeat(word, size), ids
        data, ends = row.astype("<i4").tobytes(), np.searchsorted(word, np.arange(len(marked) + 1)) * 4
        return [data[lo:hi] for lo, hi in pairwise(ends.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; new words of all texts are segmented together."""
        if self.held > KEPT_BYTES // 2:
            self.kept, self.older, self.held = {c: self.kept[c] for c in ("\n", MARK)}, self.kept, 0
        kept, older = self.kept, self.older
        cut = [self.chunks.findall(" " + t) if t else [] for t in texts]
        new = []
        for c in set().union(*cut):
            if c not in kept:
                if (ids := older.get(c)) is None:
                    new.append(c)
                else:
                    kept[c] = ids
                    self.held += WORD_BYTES + len(c) + len(ids)
        for lo, hi in _lots([len(c) for c in new], NEW_AT_ONCE):
            part = new[lo:hi]
            ids = self.viterbi([c.replace(" ", MARK) for c in part])
            kept.update(zip(part, ids, strict=True))
            self.held += sum(WORD_BYTES + len(c) + len(i) for c, i in zip(part, ids, strict=True))
        out = [b"".join([kept[c] for c in cs]) for cs in cut]
        for c in new:
            if len(c) > KEPT_LENGTH:
                self.held -= WORD_BYTES + len(c) + len(kept.pop(c))
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of piece ids, laid end to end; bytes that are not UTF-8 become U+FFFD."""
        sizes = self.size[ids]
        stop = np.cumsum(sizes)
        data = self.flat[np.repeat(self.place[ids] - stop + sizes, sizes) + np.arange(stop[-1] if len(stop) else 0)]
        cuts = np.concatenate([[0], stop])[ends].tolist()
        data = data.tobytes()
        return [data[lo + 1:hi].decode("utf-8", "replace") for lo, hi in pairwise(cuts)]


def _lots(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` in sum."""
    lo = total = 0
    for k, n in enumerate(sizes):
        total += n
        if total >= most:
            yield lo, k + 1
            lo, total = k + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def _arrow(df: DataFrame, v: Vocabulary, targets: dict[str, str], how) -> DataFrame:
    """``df`` with the columns ``targets`` (name, type), which ``how(Pieces, batch)`` gives."""
    for t in targets:
        if t in df.columns:
            raise ValueError(f"{t} is already a column")
    shipped = df.sparkSession.sparkContext.broadcast(tuple(v))
    schema = df.withColumns({t: F.lit(None).cast(kind) for t, kind in targets.items()}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(Vocabulary(*shipped.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *how(p, b)], [*b.schema.names, *targets])

    return df.mapInArrow(run, schema)


def _encode_column(p: Pieces, column: pa.Array) -> pa.Array:
    texts = column.to_pylist()
    data, ends = [], [0]
    for lo, hi in _lots([len(t or "") for t in texts], AT_ONCE):
        for ids in p.encode([t or "" for t in texts[lo:hi]]):
            data.append(ids)
            ends.append(ends[-1] + len(ids) // 4)
    flat = pa.array(np.frombuffer(b"".join(data), "<i4"))
    ends = [None if t is None else e for e, t in zip(ends, texts, strict=False)] + ends[-1:]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def _decode_column(p: Pieces, column: pa.Array) -> pa.Array:
    lengths = [n or 0 for n in pc.list_value_length(column).to_pylist()]
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    out = []
    for lo, hi in _lots(lengths, IDS_AT_ONCE):
        out += p.decode(flat[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo])
    return pa.array(out, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))


def encoded(df: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = MODEL) -> DataFrame:
    """``df`` with the piece ids of its texts."""
    return _arrow(df, load_vocabulary(vocabulary), {ids: "array<int>"}, lambda p, b: [_encode_column(p, b.column(text))])


def decoded(df: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str = MODEL) -> DataFrame:
    """``df`` with the texts of its piece ids."""
    return _arrow(df, load_vocabulary(vocabulary), {text: "string"}, lambda p, b: [_decode_column(p, b.column(ids))])


def piece_report(docs: DataFrame, vocabulary: str = MODEL) -> DataFrame:
    """doc_id, ids, n_tokens and whether decoding gives the text back (NULL text: NULLs).

    Texts are encoded, decoded and compared in one pass, by one automaton a task.
    """
    def both(p: Pieces, b: pa.RecordBatch) -> list[pa.Array]:
        text = b.column("text")
        ids = _encode_column(p, text)
        back = _decode_column(p, ids)
        return [ids, pc.cast(pc.list_value_length(ids), pa.int64()), pc.equal(back, text.cast(pa.string()))]

    rows = _arrow(docs.select("doc_id", "text"), load_vocabulary(vocabulary),
                  {"ids": "array<int>", "n_tokens": "long", "exact": "boolean"}, both)
    return rows.drop("text")
