"""Mixing sources to target weights by hierarchical budgeting (operator 2).

The corpus is a tree of domains, languages and sources. A token budget goes
down the tree: every node deals its share to its children by their weights,
but to none more than its subtree can supply (its tokens times ``epochs``).
What a child cannot take goes to its siblings, by weight again; only what all
siblings together cannot take was never dealt to their parent, and so went to
the parent's own siblings. Each leaf then gives whole epochs of its documents
and, of one more epoch in seeded order, the longest prefix that fits.

The tree's size is the number of sources, aggregated before any shuffle. The
prefix of a leaf is found by a histogram over the order's leading digits and a
ranking inside the one bucket where the budget ends, so a leaf with a third of
all documents is not sorted whole.

Defined cases: NULL languages and sources are the name "unknown"; NULL texts
have no tokens; names without a weight get ``OTHER``; children of weight 0 get
nothing; repeated rows share one place in the order and are taken together;
an empty table gives no rows; the documents' further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import WORDS_SQL, stored

# The mixture's targets: domains are made of source numbers, five to each.
DOMAINS = ("web", "news", "books", "forum")
DOMAIN_WEIGHTS = {"web": 50, "news": 20, "books": 20, "forum": 10}
LANGUAGE_WEIGHTS = {"en": 50, "de": 20, "fr": 20, "es": 10}
OTHER = 5              # weight of names that the targets do not list
SHARE = 0.8            # budget as a share of the corpus's tokens
EPOCHS = 2             # times a document may be used, at most
SEED = "mix-1"
BUCKET = 3             # leading hexadecimal digits of the order's histogram
LEAF = ["domain", "lang", "source"]


def _weight(name: str, weights: dict[str, int]):
    out = F.lit(OTHER)
    for k, w in weights.items():
        out = F.when(F.col(name) == k, w).otherwise(out)
    return out


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with the names of its place in the tree (``mix_domain`` and so on)."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"^src([0-9]{1,6})$", 1)
    slot = F.when(number != "", F.floor(number.cast("int") / 5).cast("int"))
    domain = F.lit("other")
    for k, name in enumerate(DOMAINS):
        domain = F.when(slot == k, name).otherwise(domain)
    return docs.withColumns({"mix_domain": domain, "mix_lang": F.coalesce("lang", F.lit("unknown")),
                             "mix_source": F.coalesce("source", F.lit("unknown"))})


def dealt(children: DataFrame, parents: DataFrame, key: list[str]) -> DataFrame:
    """Share each parent's ``budget`` among its ``children`` (key, name, w, supply).

    Children that cannot take their share by weight are filled first, the one
    with the least supply for its weight before all others; the rest divide
    what is left. Whole tokens: a remainder of less than one a child is not dealt.
    """
    name = [c for c in children.columns if c not in {*key, "w", "supply"}]
    rows = children.join(parents, key).filter("w > 0")
    order = Window.partitionBy(*key).orderBy(F.col("supply") / F.col("w"), *name)
    whole = Window.partitionBy(*key)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "left_budget": F.col("budget") - F.coalesce(F.sum("supply").over(before), F.lit(0)),
        "left_weight": F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))})
    full = F.col("supply").cast("double") * F.col("left_weight") <= F.col("w").cast("double") * F.col("left_budget")
    rows = rows.withColumn("full", full).withColumn("full", F.min("full").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(whole), F.lit(0))
    weight = F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)
    part = F.floor(rest.cast("double") * F.col("w") / weight).cast("long")
    return rows.withColumn("budget", F.when(F.col("full"), F.col("supply")).otherwise(F.least("supply", part))) \
               .select(*key, *name, "budget")


def leaf_budgets(tokens: DataFrame, share: float, epochs: int) -> DataFrame:
    """domain, lang, source, tokens, budget of every leaf; ``tokens`` has n_tokens a document."""
    leaves = stored(tokens.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    supply = leaves.withColumn("supply", F.col("tokens") * epochs)
    root = leaves.agg(F.least(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)).cast("double") * share).cast("long"),
                              F.coalesce(F.sum("tokens"), F.lit(0)) * epochs).alias("budget")) \
                 .withColumn("root", F.lit("corpus"))
    domains = supply.groupBy("domain").agg(F.sum("supply").alias("supply")) \
                    .withColumns({"root": F.lit("corpus"), "w": _weight("domain", DOMAIN_WEIGHTS)})
    langs = supply.groupBy("domain", "lang").agg(F.sum("supply").alias("supply")) \
                  .withColumn("w", _weight("lang", LANGUAGE_WEIGHTS))
    sources = supply.select(*LEAF, "supply").withColumn("w", F.lit(1))
    by_domain = dealt(domains, root, ["root"]).drop("root")
    by_lang = dealt(langs, by_domain, ["domain"])
    by_source = dealt(sources, by_lang, ["domain", "lang"])
    return leaves.join(by_source, LEAF)


def _order(doc_id, epoch):
    """A document's place in an epoch's seeded order: the MD5 of seed, epoch and id."""
    return F.md5(F.concat_ws(":", F.lit(SEED), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def cuts(tokens: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per leaf: budget, whole epochs, and the last place taken of one more (NULL: none)."""
    leaves = leaf_budgets(tokens, share, epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
    leaves = stored(leaves.withColumn("whole", whole)
                    .withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")), "mix-budgets")
    rows = tokens.join(leaves.select(*LEAF, "whole", "rest").filter("rest > 0"), LEAF) \
                 .withColumn("place", _order(F.col("doc_id"), F.col("whole") + 1)) \
                 .select(*LEAF, "rest", "place", "n_tokens", F.substring("place", 1, BUCKET).alias("bucket"))
    rows = stored(rows, "mix-places")
    up_to = Window.partitionBy(*LEAF).orderBy("bucket")
    buckets = rows.groupBy(*LEAF, "rest", "bucket").agg(F.sum("n_tokens").alias("n"), F.max("place").alias("last")) \
                  .withColumn("upto", F.sum("n").over(up_to))
    buckets = stored(buckets, "mix-buckets")
    inside = buckets.filter("upto <= rest").groupBy(*LEAF).agg(F.max("last").alias("last"))
    edge = buckets.filter("upto > rest AND upto - n <= rest").select(
        *LEAF, "bucket", (F.col("rest") - F.col("upto") + F.col("n")).alias("room"))
    placed_in = rows.join(edge, [*LEAF, "bucket"]) \
        .withColumn("upto", F.sum("n_tokens").over(Window.partitionBy(*LEAF).orderBy("place"))) \
        .filter("upto <= room").groupBy(*LEAF).agg(F.max("place").alias("edge_last"))
    return leaves.select(*LEAF, "budget", "whole").join(inside, LEAF, "left").join(placed_in, LEAF, "left") \
                 .select(*LEAF, "budget", "whole", F.coalesce("edge_last", "last").alias("last"))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens of every row, written once."""
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS_SQL)).cast("long")
    return stored(placed(docs).select("doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"),
                                      F.col("mix_source").alias("source"), n.alias("n_tokens")), "mix-tokens")


def _epochs(rows: DataFrame, at: DataFrame) -> DataFrame:
    """``rows`` once for every epoch that takes them, as ``mix_epoch``."""
    small = at.select(*[F.col(c).alias(f"mix_{c}") for c in LEAF], F.col("whole").alias("mix_whole"), F.col("last").alias("mix_last"))
    more = F.coalesce(_order(F.col("doc_id"), F.col("mix_whole") + 1) <= F.col("mix_last"), F.lit(False)).cast("int")
    return rows.join(small, [f"mix_{c}" for c in LEAF]) \
               .withColumn("mix_epoch", F.explode(F.slice(F.sequence(F.lit(1), F.col("mix_whole") + 1), F.lit(1), F.col("mix_whole") + more)))


def mixed(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, once for each epoch."""
    at = stored(cuts(counted(docs), share, epochs), "mix-cuts")
    return _epochs(placed(docs), at).select(*docs.columns)


def mixture_report(docs: DataFrame) -> DataFrame:
    """doc_id, epoch, leaf, n_tokens and leaf_budget of every row taken."""
    tokens = counted(docs)
    at = stored(cuts(tokens), "mix-cuts")
    rows = tokens.select("doc_id", *[F.col(c).alias(f"mix_{c}") for c in LEAF], "n_tokens")
    budget = at.select(*[F.col(c).alias(f"mix_{c}") for c in LEAF], F.col("budget").alias("leaf_budget"))
    return _epochs(rows, at).join(budget, [f"mix_{c}" for c in LEAF]).select(
        "doc_id", F.col("mix_epoch").cast("int").alias("epoch"), F.col("mix_domain").alias("domain"),
        F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"), "n_tokens", "leaf_budget")
