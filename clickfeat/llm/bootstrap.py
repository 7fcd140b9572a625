"""Personal data by bootstrapped contextual extraction (operator 12).

Base spans are four fixed kinds. The method adds spans of kind ``id``: the
valid base entities are the seeds; the one or two words before an entity are
a lexical pattern; patterns and instances (entities, and every other run that
looks like an identifier) form a graph whose edges are counted over all
documents. Each round gives a pattern the share of its word sequence's
occurrences in the whole corpus that are followed by a known instance, and an
instance the best of its patterns' scores (seeds stay at one). Patterns that
end at ``LEAST_SCORE`` or more with ``LEAST_VALUES`` distinct known values
give their identifiers, which no base pattern knows, as spans.

DataFrame functions only. Texts are read twice: once for matches (their
offsets are running sums of the gaps between them), once for the number of
occurrences of the patterns' words. Scores are whole millionths, so no sum
depends on the order of its rows.

The words of a pattern are the last two runs of letters, in lower case, among
the ``CONTEXT`` characters before an entity and after the match of the same
kind before it. An identifier is a run of ``A-Za-z0-9@._/+-`` without outer
punctuation, of 6 to 64 characters with four digits or more, that meets no
base span.

Defined cases: NULL and empty texts have no spans; repeated rows are scanned
each; a NULL doc_id is kept; an empty table gives no rows; texts of any
length are scanned whole in linear time (no pattern can backtrack over a
long run). Only doc_id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import stored

# The base kinds in the order of the digest, with their patterns.
# Possessive repeats and the look-behinds only keep a search from starting
# again inside a run that has failed; the matches are those of the plain forms.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

RUN = r"(?<![A-Za-z0-9@._/+-])[A-Za-z@._/+-]*+[0-9][A-Za-z0-9@._/+-]*+"
ADDED = "id"
CONTEXT = 60             # characters before an entity that may hold its words
LEAST_VALUES = 3         # distinct known values a pattern needs
LEAST_SCORE = 500_000    # millionths
ROUNDS = 3
SLOTS = 1 << 20          # bits of the filter in front of the corpus count


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    at = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(at, F.lit(0), lambda acc, i: acc + _luhn_term(F.substring(digits, -i, F.lit(1)).cast("int"), i))
    return total % 10 == 0


def _luhn_term(d: Column, i: Column) -> Column:
    twice = d * 2
    return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)


def _valid(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    digits = _digits(hit)
    if kind == "card":
        # The check is made only where the number has the right length.
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(8, 15)


def _matches(kind: str, pattern: str, text: Column, mark: str | None) -> Column:
    """All matches of one kind: ``kind, i, gap, n, lead, ok, value, near``.

    ``gap`` is the text's length between the match before and this one, ``n``
    the match's own, ``near`` the words before it.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if mark:
        # Texts without the mark have no match and are not searched.
        hits = F.when(F.instr(text, mark) > 0, hits).otherwise(F.array().cast("array<string>"))
        gaps = F.when(F.instr(text, mark) > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))
    else:
        gaps = F.split(text, pattern, -1)
    both = F.filter(F.arrays_zip(hits.alias("hit"), gaps.alias("gap")), lambda x: x["hit"].isNotNull())

    def match(x: Column, i: Column) -> Column:
        hit, own = x["hit"], x["hit"]
        lead = F.lit(0)
        if kind == ADDED:
            own = F.regexp_replace(hit, r"^[@._/+-]++|[@._/+-]++$", "")
            lead = F.length(hit) - F.length(F.regexp_replace(hit, r"^[@._/+-]++", ""))
            ok = F.length(own).between(6, 64) & (F.length(_digits(own)) >= 4)
        else:
            ok = _valid(kind, hit)
        words = F.regexp_extract_all(F.lower(F.right(x["gap"], F.lit(CONTEXT))), F.lit(r"\p{L}+"), F.lit(0))
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"),
                        F.length(hit).alias("n"), lead.alias("lead"), ok.alias("ok"),
                        F.when(ok, F.lower(own)).alias("value"),
                        F.when(ok, F.slice(F.reverse(words), 1, 2)).alias("near"))

    return F.transform(both, match)


def matched(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, hits``: every document with its matches of all kinds, in one pass."""
    marks = {"email": "@", "ip": ".", "phone": "+"}
    text = F.coalesce(F.col("text"), F.lit(""))
    hits = F.concat(*[_matches(k, p, text, marks.get(k)) for k, p in [*KINDS.items(), (ADDED, RUN)]])
    return stored(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", hits.alias("hits")), "pii-matches")


def placed(found: DataFrame) -> DataFrame:
    """Valid matches with their offsets: ``rid, kind, start, end, value, near``.

    Identifiers that meet a base span are left out.
    """
    rows = found.select("rid", F.inline("hits"))
    before = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("gap") + F.col("n")).over(before) - F.col("n") + F.col("lead")
    rows = rows.withColumn("start", start).filter("ok") \
               .select("rid", "kind", "start", (F.col("start") + F.length("value")).alias("end"), "value", "near")
    base = F.col("kind") != ADDED
    line = Window.partitionBy("rid").orderBy("start", "kind")
    reached = F.max(F.when(base, F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(base, F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn("reached", reached).withColumn("ahead", ahead).filter(
        base | ((F.coalesce("reached", F.lit(0)) <= F.col("start"))
                & (F.coalesce("ahead", F.col("end")) >= F.col("end")))).drop("reached", "ahead")


def patterns_of(near: Column) -> Column:
    """The patterns of the words before an entity (nearest first): its last word, its last two."""
    one, two = F.get(near, 0), F.concat(F.get(near, 1), F.lit(" "), F.get(near, 0))
    return F.filter(F.array(one, two), lambda p: p.isNotNull())


def _slot(pattern: Column) -> Column:
    return F.pmod(F.xxhash64(pattern), F.lit(SLOTS))


def occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often each pattern's words occur in all texts: ``pattern, occurs``.

    A bitmap of the patterns' hashes (of fixed size; where it is full it only
    lets more through) drops most other words before they are counted.
    """
    marked = patterns.select(_slot(F.col("pattern")).alias("s")).distinct() \
        .groupBy(F.floor(F.col("s") / 32).cast("int").alias("w")) \
        .agg(F.sum(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("bits"))
    whole = [0] * (SLOTS // 32)
    for r in marked.collect():          # at most SLOTS / 32 short rows
        whole[r["w"]] = r["bits"]
    # One row of fixed size, which a scalar subquery gives to every task.
    bitmap = docs.sparkSession.createDataFrame([(whole,)], "bitmap array<bigint>").scalar()
    # The generator evaluates the words once a text.
    words = docs.select(F.inline(F.array(F.struct(
        F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)).alias("w"))))).filter(F.size("w") > 0)
    pairs = F.zip_with("w", F.concat(F.array(F.lit(None).cast("string")), F.slice("w", 1, F.size("w") - 1)),
                       lambda x, y: F.struct(x.alias("one"), F.concat(y, F.lit(" "), x).alias("two")))
    each = words.select(F.inline(pairs))
    both = each.select(F.explode(F.array("one", "two")).alias("pattern")).filter("pattern IS NOT NULL")
    slot = _slot(F.col("pattern"))
    held = both.filter(F.getbit(F.get(bitmap, F.floor(slot / 32).cast("int")), (slot % 32).cast("int")) == 1)
    counts = held.groupBy("pattern").agg(F.count("*").alias("occurs"))
    return patterns.join(counts, "pattern", "left").select("pattern", F.coalesce("occurs", F.lit(0)).alias("occurs"))


def scored_patterns(spots: DataFrame, docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The graph's patterns with their last score: ``pattern, known, score``.

    ``known`` is the number of distinct values that are instances by
    ``LEAST_SCORE``.
    """
    seen = spots.select("value", (F.col("kind") != ADDED).alias("seed"), F.explode(patterns_of(F.col("near"))).alias("pattern"))
    edges = seen.groupBy("pattern", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    wide = edges.groupBy("pattern").agg(F.count("*").alias("values")).filter(F.col("values") >= LEAST_VALUES)
    wide = stored(wide.select("pattern"), "pii-patterns")
    sized = stored(occurrences(docs, wide), "pii-occurrences")
    graph = stored(edges.join(wide, "pattern"), "pii-graph")
    score = F.when(F.col("seed"), F.lit(1_000_000)).otherwise(F.lit(0)).cast("long")
    instances = graph.select("value", score.alias("worth")).groupBy("value").agg(F.max("worth").alias("worth"))
    for k in range(rounds):
        weighed = graph.join(instances, "value").groupBy("pattern").agg(
            F.sum(F.col("n") * F.col("worth")).alias("got"), F.sum("n").alias("n"),
            F.count_if(F.col("worth") >= LEAST_SCORE).alias("known"))
        patterns = stored(weighed.join(sized, "pattern").select(
            "pattern", "known", F.expr("got div greatest(occurs, n, 1)").alias("score")), f"pii-round-{k}")
        if k + 1 < rounds:
            trusted = patterns.filter(F.col("known") >= LEAST_VALUES)
            instances = stored(graph.join(trusted, "pattern", "left").groupBy("value").agg(
                F.max(F.when(F.col("seed"), F.lit(1_000_000).cast("long")).otherwise(F.coalesce("score", F.lit(0)))).alias("worth")),
                f"pii-instances-{k}")
    return patterns


def discovered(spots: DataFrame, docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Identifiers after a high-confidence pattern: ``rid, start, end``."""
    good = scored_patterns(spots, docs, rounds).filter((F.col("known") >= LEAST_VALUES) & (F.col("score") >= LEAST_SCORE))
    found = spots.filter(F.col("kind") == ADDED) \
        .select("rid", "start", "end", F.explode(patterns_of(F.col("near"))).alias("pattern"))
    return found.join(good.select("pattern"), "pattern", "left_semi").select("rid", "start", "end").distinct()


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """All spans of every document: ``rid, doc_id, spans`` (structs kind, start, end).

    Base spans come by kind, then start; added ones (kind ``id``) follow.
    """
    docs = docs.select("doc_id", "text")
    found = matched(docs)
    spots = stored(placed(found), "pii-spans")
    added = discovered(spots, docs, rounds).withColumn("kind", F.lit(ADDED))
    order = F.array_position(F.array(*[F.lit(k) for k in [*KINDS, ADDED]]), F.col("kind"))
    spans = spots.filter(F.col("kind") != ADDED).select("rid", "kind", "start", "end") \
        .unionByName(added.select("rid", "kind", "start", "end")) \
        .groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "start", "end", "kind"))).alias("s"))
    own = F.transform(F.coalesce("s", F.array()), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.select("rid", "doc_id").join(spans, "rid", "left").select("rid", "doc_id", own.alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def private_report(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The digest of ``personal_data``, one row a document, and the number of added spans."""
    rows = personal_data(docs, rounds)
    of = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] != ADDED)
    return rows.select("doc_id", *[of(k).alias(f"n_{k}") for k in KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
                       listed(F.col("spans")).alias("spans"), of(ADDED).alias("n_added"))
