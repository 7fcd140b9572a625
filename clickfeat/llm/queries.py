"""The queries of this subpackage: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickfeat.llm import bootstrap, centroids, forest, jaccard, lattice, mixing, negatives, pieces, secrets, spans, topk, toxicity, wrappers
from clickfeat.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.span_report(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(table(spark, sf_dir, "documents"))


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_documents(table(spark, sf_dir, "documents"))


def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_report(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(table(spark, sf_dir, "pages"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_report(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


def op12_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap.private_report(table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def catalogue() -> dict[str, Query]:
    return {q.__name__: q for q in (op1_spans, op2_mixing, op3_lattice, op4_forest, op5_jaccard, op6_topk, op7_toxicity, op8_html, op9_pieces, op10_secrets,
                                    op11_centroids, op12_bootstrap, op13_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": MIXING_SQL, "op4_forest": FOREST_SQL, "op5_jaccard": JACCARD_SQL, "op6_topk": TOPK_SQL, "op11_centroids": centroids_sql(), "op13_negatives": NEGATIVES_SQL}


# Links, then everything reachable by them.
FOREST_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS q FROM embeddings),
u AS (
  SELECT *, sqrt(list_dot_product(q, q)) AS size FROM v
  WHERE len(q) > 0 AND len(list_filter(q, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(q, q) > 0),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b
  ON a.rid <> b.rid AND len(a.q) = len(b.q) AND list_dot_product(a.q, b.q) / (a.size * b.size) >= 0.9),
reach(rid, id) AS (
  SELECT rid, vec_id FROM v UNION SELECT links.b, reach.id FROM reach JOIN links ON links.a = reach.rid),
c AS (SELECT rid, min(id) AS component_id FROM reach GROUP BY rid),
n AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c USING (rid) LEFT JOIN n USING (rid)
"""

JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
t AS (SELECT rid, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w WHERE len(words) >= 5),
g AS (
  SELECT rid, i + 4 <= n AS whole, concat_ws(' ', word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p) AS shingle
  FROM t WINDOW p AS (PARTITION BY rid ORDER BY i)),
e AS (
  SELECT DISTINCT rid, shingle FROM g WHERE whole
  UNION ALL SELECT rid, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 4),
d AS (SELECT w.rid, doc_id, CAST(count(shingle) AS BIGINT) AS n_shingles FROM w LEFT JOIN e ON e.rid = w.rid GROUP BY w.rid, doc_id),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS n FROM e a JOIN e b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY 1, 2),
links AS (
  SELECT shared.a, shared.b FROM shared JOIN d x ON x.rid = shared.a JOIN d y ON y.rid = shared.b
  WHERE 100 * shared.n >= 80 * (x.n_shingles + y.n_shingles - shared.n)),
reach(rid, id) AS (
  SELECT rid, doc_id FROM d UNION SELECT links.b, reach.id FROM reach JOIN links ON links.a = reach.rid),
c AS (SELECT rid, min(id) AS component_id FROM reach GROUP BY rid)
SELECT doc_id, n_shingles, component_id, n_shingles = 0 OR doc_id = component_id AS kept FROM d JOIN c USING (rid)
"""

NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.rid <> b.rid AND len(a.q) = len(b.q)),
p AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.rid = s.rid AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
  WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def centroids_sql(rounds: int = centroids.ROUNDS) -> str:
    """The start, ``rounds`` of assigning and averaging, and a last assignment, each as a few CTEs."""
    ctes = [f"""v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {centroids.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || CAST(vec_id AS VARCHAR)), q) - 1 AS INTEGER) AS c, q
  FROM v WHERE vec_id IS NOT NULL QUALIFY c < {centroids.CENTROIDS})"""]
    for k in range(rounds + 1):
        ctes.append(f"""a{k} AS (
  SELECT v.rid, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(v.q, c{k}.q), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT), c := c{k}.c)) AS m
  FROM v JOIN c{k} ON true GROUP BY v.rid)""")
        if k < rounds:
            ctes.append(f"""s{k} AS (
  SELECT a{k}.m.c AS c, i, CAST(sum(v.q[i]) AS BIGINT) AS s, count(*) AS n
  FROM a{k} JOIN v USING (rid), range(1, {centroids.DIMS + 1}) r(i) GROUP BY 1, 2),
m{k} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM s{k} GROUP BY c),
c{k + 1} AS (
  SELECT c, coalesce(m{k}.q, c{k}.q) AS q FROM c{k} LEFT JOIN m{k} USING (c))""")
    last = f"a{rounds}"
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, {last}.m.c AS cluster, {last}.m.d AS distance,
       CAST(sum({last}.m.d) OVER (PARTITION BY {last}.m.c) AS BIGINT) AS cluster_inertia, CAST(sum({last}.m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM {last} JOIN v USING (rid) JOIN c{rounds} ON c{rounds}.c = {last}.m.c"""


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

# The budget's path down the tree, one level after another, then each leaf's prefix.
MIXING_SQL = """
WITH t AS (
  SELECT doc_id,
         CASE TRY_CAST(nullif(regexp_extract(coalesce(source, ''), '^src([0-9]{1,6})$', 1), '') AS INTEGER) // 5
              WHEN 0 THEN 'web' WHEN 1 THEN 'news' WHEN 2 THEN 'books' WHEN 3 THEN 'forum' ELSE 'other' END AS domain,
         coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
leaf AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * 2 AS BIGINT) AS supply
  FROM t GROUP BY ALL),
root AS (
  SELECT least(CAST(floor(CAST(sum(tokens) AS DOUBLE) * 0.8) AS BIGINT), CAST(sum(supply) AS BIGINT)) AS budget FROM leaf),
d0 AS (
  SELECT domain, CAST(sum(supply) AS BIGINT) AS supply,
         CASE domain WHEN 'web' THEN 50 WHEN 'news' THEN 20 WHEN 'books' THEN 20 WHEN 'forum' THEN 10 ELSE 5 END AS w,
         (SELECT budget FROM root) AS budget
  FROM leaf GROUP BY domain),
d1 AS (
  SELECT *, budget - coalesce(sum(supply) OVER (ORDER BY supply / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lb,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY supply / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lw
  FROM d0),
d2 AS (
  SELECT *, bool_and(CAST(supply AS DOUBLE) * lw <= CAST(w AS DOUBLE) * lb) OVER (ORDER BY supply / w, domain ROWS UNBOUNDED PRECEDING) AS f
  FROM d1),
d AS (
  SELECT domain, CASE WHEN f THEN supply ELSE least(supply, CAST(floor(
           CAST(budget - coalesce(sum(CASE WHEN f THEN supply END) OVER (), 0) AS DOUBLE) * w / sum(CASE WHEN NOT f THEN w END) OVER ()) AS BIGINT)) END AS budget
  FROM d2),
l0 AS (
  SELECT domain, lang, CAST(sum(supply) AS BIGINT) AS supply,
         CASE lang WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 10 ELSE 5 END AS w, any_value(d.budget) AS budget
  FROM leaf JOIN d USING (domain) GROUP BY domain, lang),
l1 AS (
  SELECT *, budget - coalesce(sum(supply) OVER (PARTITION BY domain ORDER BY supply / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lb,
         sum(w) OVER (PARTITION BY domain) - coalesce(sum(w) OVER (PARTITION BY domain ORDER BY supply / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lw
  FROM l0),
l2 AS (
  SELECT *, bool_and(CAST(supply AS DOUBLE) * lw <= CAST(w AS DOUBLE) * lb) OVER (PARTITION BY domain ORDER BY supply / w, lang ROWS UNBOUNDED PRECEDING) AS f
  FROM l1),
l AS (
  SELECT domain, lang, CASE WHEN f THEN supply ELSE least(supply, CAST(floor(
           CAST(budget - coalesce(sum(CASE WHEN f THEN supply END) OVER (PARTITION BY domain), 0) AS DOUBLE) * w
           / sum(CASE WHEN NOT f THEN w END) OVER (PARTITION BY domain)) AS BIGINT)) END AS budget
  FROM l2),
s0 AS (
  SELECT domain, lang, source, tokens, supply, 1 AS w, l.budget FROM leaf JOIN l USING (domain, lang)),
s1 AS (
  SELECT *, budget - coalesce(sum(supply) OVER (PARTITION BY domain, lang ORDER BY supply / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lb,
         sum(w) OVER (PARTITION BY domain, lang) - coalesce(sum(w) OVER (PARTITION BY domain, lang ORDER BY supply / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lw
  FROM s0),
s2 AS (
  SELECT *, bool_and(CAST(supply AS DOUBLE) * lw <= CAST(w AS DOUBLE) * lb) OVER (PARTITION BY domain, lang ORDER BY supply / w, source ROWS UNBOUNDED PRECEDING) AS f
  FROM s1),
s AS (
  SELECT domain, lang, source, tokens, CAST(CASE WHEN f THEN supply ELSE least(supply, CAST(floor(
           CAST(budget - coalesce(sum(CASE WHEN f THEN supply END) OVER (PARTITION BY domain, lang), 0) AS DOUBLE) * w
           / sum(CASE WHEN NOT f THEN w END) OVER (PARTITION BY domain, lang)) AS BIGINT)) END AS BIGINT) AS leaf_budget
  FROM s2),
e AS (
  SELECT *, CASE WHEN tokens > 0 THEN CAST(leaf_budget // tokens AS INTEGER) ELSE 0 END AS whole FROM s),
p AS (
  SELECT t.*, e.leaf_budget, e.whole, e.leaf_budget - e.whole * e.tokens AS rest,
         md5(concat_ws(':', 'mix-1', CAST(e.whole + 1 AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))) AS place
  FROM t JOIN e USING (domain, lang, source)),
u AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM p),
x AS (
  SELECT *, unnest(range(1, 1 + whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch FROM u)
SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, domain, lang, source, n_tokens, leaf_budget FROM x
"""
