"""Toxicity by weak supervision (operator 7).

Voters are words (a lexicon) and word beginnings (patterns) that labelled
training rows show to be toxic. A generative label model then looks at their
votes alone: an expectation-maximisation over two latent classes estimates how
often each voter fires in either class, and how voters correlate within a
class; correlated voters (a word and its own beginnings, say) share one
voter's weight. Its posterior labels, not the given ones, train a logistic
classifier on the votes, which scores every text.

Labels are read from training rows only. The classifier and its voters are
fitted on at most ``SAMPLE`` labelled rows, chosen by hash, where each further
voter must add to what the ones before it tell; the choice ends there or with
``VOTERS`` voters out of the ``CANDIDATES`` commonest. All texts are scored;
neither labels nor lang, source or doc_id enter a score.

Defined cases: NULL and empty texts have no votes and get the score of a text
without votes; labels that are NULL are skipped and a doc_id that is labelled
twice counts with its larger label; repeated rows are scored each; without
toxic training rows every score is 0; texts of any length are scored whole; an
empty table gives no rows; only doc_id and text (and the labels'
doc_id and toxic) are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import bounded_sample, crc_mod, raw, stored

SAMPLE = 20_000        # labelled rows the voters and the classifier are fitted on
CANDIDATES = 2000      # candidates compared on the sample, at most
VOTERS = 192           # voters kept, at most
LEAST, ODDS = 4, 15.0  # toxic rows a voter needs, and its ratio of rates
BEGIN = (4, 5, 6, 7, 8)  # lengths of word beginnings, in bytes
TIMES = 3              # a beginning has voters for one to this many of its words
ROUNDS = 50            # of the label model
FLUSH = 400_000
EDGES = b".,;:!?*#$%&|\"'()[]{}<>-_/\\"


class Model(NamedTuple):
    """Voters (w: whole word, p1 to p3: so many words with a beginning) with their weights, and the intercept."""

    voters: list[tuple[str, bytes]]
    weights: list[float]
    bias: float


def tokens(text: bytes | None) -> Counter:
    """The words of a text with their numbers, without punctuation at their ends."""
    return Counter([w.strip(EDGES) for w in text.lower().split()] if text else ())


def features(found: Counter) -> set[tuple[str, bytes]]:
    """All (kind, word) a text could vote with; kinds p1 to p3 count a beginning's words."""
    starts = Counter()
    for w, k in found.items():
        for n in BEGIN:
            if len(w) >= n:
                starts[w[:n]] += k
    out = {("w", w) for w in found if w}
    for b, k in starts.items():
        out.update((f"p{t}", b) for t in range(1, min(k, TIMES) + 1))
    return out


def votes(found: Counter, words: dict[bytes, int], begins: dict[bytes, list[tuple[int, int]]]) -> list[int]:
    """Numbers of the voters that fire on the words of a text."""
    hit = [words[w] for w in found.keys() & words.keys()]
    starts = Counter()
    for w, k in found.items():
        for n in BEGIN:
            if w[:n] in begins and len(w) >= n:
                starts[w[:n]] += k
    hit += [i for b, k in starts.items() for t, i in begins[b] if k >= t]
    return sorted(hit)


def _tables(voters: list[tuple[str, bytes]]):
    words = {w: i for i, (k, w) in enumerate(voters) if k == "w"}
    begins: dict[bytes, list[tuple[int, int]]] = {}
    for i, (k, w) in enumerate(voters):
        if k != "w":
            begins.setdefault(w, []).append((int(k[1:]), i))
    return words, begins


def training_rows(docs: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """``text, toxic`` of at most SAMPLE labelled rows for which ``learn`` holds, one a doc_id (least text hash)."""
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL") \
                   .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(learn)
    marked = bounded_sample(marked, "doc_id", SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("r"))
    return stored(one.select("r.text", "r.toxic"), "toxic-sample")


def find_voters(rows: DataFrame) -> list[tuple[str, bytes]]:
    """Words and beginnings far more frequent in toxic rows, by their evidence."""
    sizes = {r["toxic"] == 1: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(True, 0), sum(n for k, n in sizes.items() if not k)
    if not toxic:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def flush():
            both = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in both], pa.string()), pa.array([w for _, w in both], pa.binary()),
                 *[pa.array([c[x] for x in both], pa.int64()) for c in seen]], ["kind", "word", "n0", "n1"])
            for c in seen:
                c.clear()

        for b in batches:
            for text, t in zip(raw(b.column("text")), b.column("toxic").to_pylist(), strict=True):
                seen[t == 1].update(features(tokens(text)))
            if sum(map(len, seen)) > FLUSH:
                yield from flush()
        yield from flush()

    counts = rows.mapInArrow(run, "kind string, word binary, n0 long, n1 long") \
                 .groupBy("kind", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    ratio = ((F.col("n1") + 0.1) / (toxic + 1)) / ((F.col("n0") + 0.1) / (clean + 1))
    strong = counts.filter((F.col("n1") >= LEAST) & (ratio >= ODDS))
    best = strong.orderBy(F.desc(F.col("n1") * F.log(ratio)), F.desc("kind"), F.desc("word")).limit(CANDIDATES).collect()
    found = [(r["kind"], bytes(r["word"])) for r in best]
    if not found:
        return []
    # Then those that speak for rows few others speak for, or differ from the others.
    fired = vote_matrix(rows, found)
    y = np.array([r["toxic"] == 1 for r in rows.select("toxic").collect()])
    on, off, need, kept = fired[y], fired[~y].sum(0), np.ones(int(y.sum())), []
    for _ in range(min(VOTERS, len(found))):
        gain = need @ on / (1.0 + off)
        gain[kept] = -1.0
        i = int(gain.argmax())
        if gain[i] < 0.5:
            break
        kept.append(i)
        need[on[:, i] > 0] *= 0.6
    return [found[i] for i in kept]


def vote_matrix(rows: DataFrame, voters: list[tuple[str, bytes]]) -> np.ndarray:
    """Which voters fire on each of the sampled rows (at most SAMPLE), in stored order."""
    tables = _tables(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([votes(tokens(t), *tables) for t in raw(b.column("text"))], pa.list_(pa.int32()))], ["hit"])

    found = rows.select("text").mapInArrow(run, "hit array<int>").collect()
    fired = np.zeros((len(found), len(voters)), np.float32)
    for k, r in enumerate(found):
        fired[k, r["hit"]] = 1.0
    return fired


def label_model(fired: np.ndarray) -> np.ndarray:
    """Posterior probability of the toxic class for each row of a vote matrix.

    Two latent classes; a voter that does not fire abstains, one that fires has
    a rate in each class. A voter's log odds are divided by its summed
    correlation with the voters that fire beside it within a class.
    """
    n, m = fired.shape
    silent = ~fired.any(1)
    post = np.where(silent, 0.01, 0.9)           # voters speak for the toxic class
    for _ in range(ROUNDS):
        w1, w0 = post.sum(), (1 - post).sum()
        prior = np.clip(w1 / n, 1e-3, 0.5)
        rate1 = np.clip((post @ fired + 0.5) / (w1 + 1), 1e-6, 1 - 1e-6)
        rate0 = np.clip(((1 - post) @ fired + 0.1) / (w0 + 1), 1e-6, 1 - 1e-6)
        within = np.zeros((m, m))
        for p, r, w in ((post, rate1, w1), (1 - post, rate0, w0)):
            cov = (fired * p[:, None]).T @ fired / max(w, 1) - np.outer(r, r)
            spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            within += (w / n if r is rate0 else 1 - w0 / n) * np.clip(cov / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(within, 1.0)
        crowd = 1.0 + fired @ np.where(within > 0.2, within, 0) - fired   # per row: who fires beside a voter
        odds = np.log(rate1 / rate0)
        # That no voter fires is evidence too, counted once.
        mute1, mute0 = ((p @ silent + 0.1) / (w + 1) for p, w in ((post, w1), (1 - post, w0)))
        logit = np.log(prior / (1 - prior)) + silent * np.log(mute1 / mute0) + (fired * odds / np.maximum(crowd, 1.0)).sum(1)
        new = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        if np.abs(new - post).max() < 1e-6:
            return new
        post = new
    return post


def linear_classifier(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], penalty * 10)
    ridge[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        step = np.linalg.solve((z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(ridge),
                               z.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, learn) -> Model | None:
    """The fitted scorer; None if no training row is toxic."""
    rows = training_rows(docs, labels, learn)
    voters = find_voters(rows)
    if not voters:
        return None
    fired = vote_matrix(rows, voters).astype(float)
    weights, bias = linear_classifier(fired, label_model(fired))
    return Model(voters, weights.tolist(), bias)


def scored(docs: DataFrame, model: Model | None, column: str = "score") -> DataFrame:
    """``docs`` with the probability of the toxic class of each text."""
    if model is None:
        return docs.withColumn(column, F.lit(0.0))
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, weights, bias = shipped.value
        tables = _tables(voters)
        for b in batches:
            z = [bias + sum(weights[i] for i in votes(tokens(t), *tables)) for t in raw(b.column("text"))]
            score = 1 / (1 + np.exp(-np.clip(np.array(z, float), -500, 500)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*b.schema.names, column])

    return docs.mapInArrow(run, docs.withColumn(column, F.lit(0.0)).schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    held = crc_mod("doc_id", 5) == 0
    model = train(docs, labels, ~held)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the scorer does not reject."""
    model = train(docs, labels, crc_mod("doc_id", 5) != 0)
    score = "toxicity_score"
    return scored(docs, model, score).filter(F.col(score) < 0.5).drop(score)
