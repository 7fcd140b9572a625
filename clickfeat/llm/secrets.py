"""Secret scans by a randomness test battery (operator 10).

Base spans come from three fixed patterns. The method adds spans: every
long token whose inferred encoding (upper- or mixed-case base 16, base 32,
base 36, base 62, base 64, base 64 of URLs) is a credential's takes three
tests of randomness over that alphabet (chi-squared uniformity, runs about
the median symbol, serial correlation), and its evidence against prose must
survive a false-discovery control per length class.

The evidence is an e-value, the product of two factors. One is the likelihood
of the token under uniform symbols over that under the corpus's own
first-order model of character classes, counted over every long token of
every document outside base spans. The other is the battery's combined
p-value over its mean for uniform tokens of the same alphabet and length
class (by seeded simulation): its mean is one where symbols are uniform, so
the product's mean is at most one under prose. A token that fails the battery
outright (``RANDOM_LEVEL``) is no candidate, and any other loses as much
evidence as the tests hold against it. Within each length class the e-values of all
long tokens go through the e-BH procedure at ``ALPHA``.

Defined cases: NULL and empty texts have no spans; repeated rows are scanned
each; a NULL doc_id is kept; only doc_id and text (or the documents columns)
are read, so further columns cannot clash; texts of any length are scanned
whole, in time linear in their length. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import stored

# Fixed values of the scan's base patterns: kind, pattern, shortest match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
# Inferred encodings: name, alphabet; the first that holds all symbols wins.
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = (
    ("base16", DIGITS + LOWER[:6]), ("base16", DIGITS + UPPER[:6]), ("base32", UPPER + DIGITS[2:8]),
    ("base36", DIGITS + LOWER), ("base36", DIGITS + UPPER), ("base62", UPPER + LOWER + DIGITS),
    ("base64", UPPER + LOWER + DIGITS + "+/"), ("base64url", UPPER + LOWER + DIGITS + "-_"),
)
ALPHA = 0.01            # false-discovery rate of the added spans
RANDOM_LEVEL = 0.001    # a battery p-value below this rejects randomness
SIMULATED = 200         # uniform tokens for the mean p-value of an alphabet and length class
LENGTHS = (16, 20, 24, 32, 48, 64, 128)  # lower ends of the length classes
STEP, BINS = 0.5, 400   # bins of the e-value histogram (natural log)

_CLASS = {c: (0 if c in LOWER else 1 if c in UPPER else 2 if c in DIGITS else 3)
          for c in UPPER + LOWER + DIGITS + "+/_-"}
_CLASS_SIZE = (26, 26, 10, 4)


def length_class(n: int) -> int:
    return max(k for k, low in enumerate(LENGTHS) if n >= low)


def encoding(token: str) -> tuple[str, str] | None:
    """Name and alphabet of a token's encoding; None for numbers and letters of one case."""
    kinds = {_CLASS[c] for c in set(token)}
    if not kinds & {0, 1} or (2 not in kinds and not {0, 1} <= kinds):
        return None
    have = set(token)
    return next(((n, a) for n, a in ENCODINGS if have <= set(a)), None)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def tests(token: str, alphabet: str) -> tuple[float, float, float]:
    """The p-values of "uniform symbols": chi-squared, runs, serial correlation."""
    at = {c: k for k, c in enumerate(alphabet)}
    x, size, n = [at[c] for c in token], len(alphabet), len(token)
    # Chi-squared uniformity over equal slices of the alphabet, five expected in each.
    bins = max(2, min(size, n // 5))
    seen, width = [0] * bins, [0] * bins
    for k in range(size):
        width[k * bins // size] += 1
    for v in x:
        seen[v * bins // size] += 1
    chi = sum((s - n * w / size) ** 2 / (n * w / size) for s, w in zip(seen, width, strict=True))
    df = bins - 1
    # Wilson-Hilferty: the cube root of chi-squared / df is close to normal.
    z = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    # Runs about the median symbol.
    high = [v * 2 >= size for v in x]
    up = sum(high)
    down, runs = n - up, 1 + sum(p != q for p, q in zip(high, high[1:], strict=False))
    if up and down:
        mean = 1 + 2 * up * down / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        run = _two_sided((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        run = 2.0 ** (1 - n)
    # Lag-one serial correlation.
    mid = sum(x) / n
    var = sum((v - mid) ** 2 for v in x)
    serial = _two_sided(sum((p - mid) * (q - mid) for p, q in zip(x, x[1:], strict=False)) / var * math.sqrt(n)) if var else 0.0
    return uniform, run, serial


def battery(token: str, alphabet: str) -> float:
    """The three tests' combined p-value: the least, times three."""
    return min(1.0, 3 * min(tests(token, alphabet)))


def calibration() -> dict[tuple[str, int], float]:
    """The mean combined p-value of uniform tokens, by alphabet and length class."""
    rng = random.Random("battery")
    return {(a, k): sum(battery("".join(rng.choices(a, k=n)), a) for _ in range(SIMULATED)) / SIMULATED
            for a in {a for _, a in ENCODINGS} for k, n in enumerate(LENGTHS)}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three fixed patterns, in order."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _joined_up(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The stretches that sorted spans cover, in order, none touching in part."""
    out: list[tuple[int, int]] = []
    for s, _, e in spans:
        if out and s < out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def scan(text: str | None, mean_p: dict[tuple[str, int], float]):
    """Base spans, candidates and the prose counts of one text.

    A candidate is (start, end, log likelihood under uniform symbols with the
    battery's factor, class transition counts); the prose counts are the class transitions of all long
    tokens outside base spans (16 cells) and their number in each length class.
    """
    text = text or ""
    base = base_spans(text)
    moves, lengths, found = [0] * 16, [0] * len(LENGTHS), []
    covered, k = _joined_up(base), 0
    for m in TOKEN.finditer(text):
        token = m[0]
        n = len(token)
        while k < len(covered) and covered[k][1] <= m.start():
            k += 1
        if k < len(covered) and covered[k][0] < m.end():
            continue    # known already, and no example of prose
        group = length_class(n)
        lengths[group] += 1
        if token.isalpha() and token.islower():
            moves[0] += n - 1
            continue
        own = [0] * 16
        at = [_CLASS[c] for c in token]
        for p, q in zip(at, at[1:], strict=False):
            own[4 * p + q] += 1
        moves = [p + q for p, q in zip(moves, own, strict=True)]
        kind = encoding(token)
        if kind is None:
            continue
        p = battery(token, kind[1])
        if p >= RANDOM_LEVEL:
            found.append({"start": m.start(), "end": m.end(), "moves": own,
                          "uniform": math.log(p / mean_p[kind[1], group]) - (n - 1) * math.log(len(kind[1]))})
    return base, found, moves, lengths


SCAN_FIELDS = ("base array<struct<start:int,kind:int,end:int>>, "
               "found array<struct<start:int,end:int,uniform:double,moves:array<int>>>, "
               "moves array<int>, lengths array<int>")


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: base spans, candidates, prose counts (written once)."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, {SCAN_FIELDS}"
    mean_p = calibration()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for b in batches:
            rows = [scan(t, mean_p) for t in b.column("text").to_pylist()]
            kinds = kinds or [
                pa.list_(pa.struct([(f, pa.int32()) for f in ("start", "kind", "end")])),
                pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                    ("uniform", pa.float64()), ("moves", pa.list_(pa.int32()))])),
                pa.list_(pa.int32()), pa.list_(pa.int32())]
            cols = [[[{"start": s, "kind": k, "end": e} for s, k, e in r[0]] for r in rows],
                    *[[r[i] for r in rows] for i in (1, 2, 3)]]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]],
                ["doc_id", "base", "found", "moves", "lengths"])

    return stored(source.mapInArrow(run, schema), "secrets")


def prose_model(rows: DataFrame) -> list[float]:
    """Log probability of each class-to-symbol step (16 cells), from all long tokens."""
    sums = rows.select([F.sum(F.col("moves")[k].cast("long")).alias(f"m{k}") for k in range(16)]).first()
    seen = [(sums[k] or 0) + 0.5 for k in range(16)]
    return [math.log(seen[k] / sum(seen[4 * (k // 4):4 * (k // 4) + 4]) / _CLASS_SIZE[k % 4])
            for k in range(16)]


def evidence(candidate, model: list[float]):
    """Log e-value as a SQL expression over a candidate column."""
    prose = sum(F.element_at(candidate["moves"], k + 1) * F.lit(w) for k, w in enumerate(model))
    return candidate["uniform"] - prose


def thresholds(rows: DataFrame, model: list[float]) -> list[float | None]:
    """The least log e-value that each length class accepts (e-BH); None: none.

    The histogram has at most classes x bins rows, whatever the corpus.
    """
    tested = rows.select([F.sum(F.col("lengths")[k].cast("long")).alias(f"n{k}")
                          for k in range(len(LENGTHS))]).first()
    c = F.col("c")
    size = c["end"] - c["start"]
    group = sum((F.when(size >= low, 1).otherwise(0) for low in LENGTHS[1:]), F.lit(0))
    counts = rows.select(F.explode("found").alias("c")).select(
        group.alias("g"), F.least(F.lit(BINS), F.floor(evidence(c, model) / STEP)).alias("bin")) \
        .filter("bin >= 0").groupBy("g", "bin").count().collect()
    out: list[float | None] = []
    for g in range(len(LENGTHS)):
        own = sorted(((r["bin"], r["count"]) for r in counts if r["g"] == g), reverse=True)
        total, least = 0, None
        for at, n in own:
            total += n
            if at * STEP >= math.log((tested[g] or 0) / (total * ALPHA)):
                least = at * STEP
        out.append(least)
    return out


def secret_spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, spans`` (array of start, kind, end; in order) of every row of ``docs``."""
    rows = scanned(docs, text, key)
    model = prose_model(rows)
    least = thresholds(rows, model)

    def accepted(c):
        size = c["end"] - c["start"]
        bound = F.lit(math.inf)
        for low, t in zip(LENGTHS, least, strict=True):
            bound = F.when(size >= low, F.lit(math.inf if t is None else t)).otherwise(bound)
        return evidence(c, model) >= bound

    added = F.transform(F.filter("found", accepted), lambda c: F.struct(
        c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def joined(spans):
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, digest of the base spans, all spans as text."""
    rows = secret_spans(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == 3)).cast("long").alias("n_random"))


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """``text`` with every stretch covered by spans replaced by one ``mask``."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def digest(spans: list[tuple[int, int, int]]) -> str:
    """The base digest of plain (start, kind, end) spans, as the query returns it."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` (documents columns) with every secret replaced; n_chars follows the text.

    The accepted thresholds are fixed first, then each text is scanned and
    masked where it lies, so texts are never shuffled or joined.
    """
    rows = scanned(docs)
    model = prose_model(rows)
    least = thresholds(rows, model)
    mean_p, schema = calibration(), docs.schema

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        base, found, _, _ = scan(text, mean_p)
        spans = [(s, e) for s, _, e in base]
        for c in found:
            bound = least[length_class(c["end"] - c["start"])]
            prose = sum(n * w for n, w in zip(c["moves"], model, strict=True))
            if bound is not None and c["uniform"] - prose >= bound:
                spans.append((c["start"], c["end"]))
        return masked(text, spans, mask) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [clean(t) for t in b.column("text").to_pylist()]
            cols = {n: b.column(n) for n in b.schema.names}
            cols["text"] = pa.array(texts, b.schema.field("text").type)
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in texts],
                                           b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return docs.mapInArrow(run, schema)
