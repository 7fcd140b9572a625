"""Every query over tables of awkward rows and over empty tables."""

import fixtures_llm as X
import pytest
from fixtures_llm import empty, odd  # noqa: F401

from clickfeat.llm import queries as Q

NAMES = sorted(Q.catalogue())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    assert Q.catalogue()[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("op2_mixing", "op6_topk", "op8_html", "op4_forest", "op11_centroids", "op13_negatives")])
def test_one_row_a_document(spark, odd, name):
    rows = Q.catalogue()[name](spark, odd).collect()
    want = sorted((r[0] is None, r[0] or 0) for r in X.documents())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == want


def test_spans(spark, odd):
    rows = {r["doc_id"]: r for r in Q.op1_spans(spark, odd).collect()}
    docs = [(i, t) for i, t in ((r[0], r[1]) for r in X.documents()[:-2])]
    for i, (n, _) in X.repeated_sentences(docs).items():
        assert rows[i]["n_sentences"] == n
    assert rows[13]["n_removed"] >= 2 and rows[12]["n_removed"] == 0
    assert rows[0]["removed"] == ""


def test_mixing(spark, odd):
    rows = Q.op2_mixing(spark, odd).collect()
    spent = {}
    for r in rows:
        leaf = (r["domain"], r["lang"], r["source"], r["leaf_budget"])
        spent[leaf] = spent.get(leaf, 0) + r["n_tokens"]
    assert all(n <= leaf[3] for leaf, n in spent.items())
    assert any(leaf[1] == "unknown" for leaf in spent)


def test_forest(spark, odd):
    rows = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in Q.op4_forest(spark, odd).collect()]
    # 0, 1, 1, NULL, 40 are equal and 2 has their direction: six rows, five links each.
    assert sorted(rows, key=str) == sorted(
        [(0, 5, 0, True), (1, 5, 0, False), (1, 5, 0, False), (2, 5, 0, False), (None, 5, 0, False), (40, 5, 0, False)]
        + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 20)], key=str)


def test_jaccard(spark, odd):
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in Q.op5_jaccard(spark, odd).collect()]
    got = {r[0]: r for r in rows}
    sizes, comp = X.jaccard_components([(r[0], r[1]) for r in X.documents()[:-2]])
    assert {i: (got[i][1], got[i][2]) for i in comp} == {i: (sizes[i], comp[i]) for i in comp}
    assert got[None][2] == 3 and not got[None][3]
    assert sum(r[3] for r in rows) == len({(c if sizes[i] else -i) for i, c in comp.items()})


def test_topk(spark, odd):
    rows = Q.op6_topk(spark, odd).collect()
    assert {r["query_id"] for r in rows} == {0, 20, 40}
    first = [(r["rank"], r["vec_id"], r["score"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == 0]
    assert first == [(1, 2, 64 * 128 + 128 * 256), (2, 1, 64 * 64 + 128 * 128), (3, 40, 64 * 64 + 128 * 128), (4, 3, 0), (5, 20, 0)]


def test_html(spark, odd):
    rows = {r["page_id"]: (r["text"], r["n_chars"]) for r in Q.op8_html(spark, odd).collect()}
    assert rows == {0: ("", 0), 1: ("", 0), None: ("plain & text", 12), 3: ("", 0), 4: ("T One bold Two", 14)} or rows[3] == ("just text", 9)
    assert rows[4] == ("T One bold Two", 14)


def test_pieces(spark, odd):
    rows = Q.op9_pieces(spark, odd).collect()
    assert all(r["exact"] for r in rows if r["doc_id"] != 0)
    assert [r for r in rows if r["doc_id"] == 0][0]["ids"] is None
    assert [r for r in rows if r["doc_id"] == 1][0]["n_tokens"] == 0


def test_secrets(spark, odd):
    texts = {r[0]: r[1] for r in X.documents() if r[0] is not None}
    for r in Q.op10_secrets(spark, odd).collect():
        if r["doc_id"] is not None:
            *counts, digest, spans = X.base_secrets(texts[r["doc_id"]])
            assert [r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]] == [*counts, digest]
            assert set(filter(None, spans.split(","))) <= set(r["spans"].split(","))


def test_pipeline(spark, odd, empty):
    import corpus_pipeline as P

    assert P.run(spark, empty).count() == 0
    rows = P.run(spark, odd).collect()
    assert all(r["exact"] or r["ids"] is None for r in rows)
    assert len([r for r in rows if r["doc_id"] in (3, 4, 5, 6)]) <= 1
