"""Each stage of the corpus pipeline by itself, on awkward rows and on empty tables."""

import fixtures_llm as X
import pytest
from fixtures_llm import empty, odd  # noqa: F401

import corpus_pipeline as P

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run(spark, k, sf_dir):
    return P.STAGES[k][1](spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("k", range(5))
def test_empty(spark, empty, k):
    out = run(spark, k, empty)
    assert out.count() == 0 and (k == 4 or out.columns == COLUMNS)


def given(*drop):
    return sorted(((r[0], r[1], r[2], r[3], r[4]) for r in X.documents()), key=str)


def test_toxicity_keeps_clean_rows_as_they_are(spark, odd):
    out = run(spark, 0, odd)
    assert out.columns == COLUMNS
    assert set(rows(out)) <= set(given()) and len(rows(out)) >= len(given()) - 1
    assert {None, ""} <= {r[1] for r in rows(out) if r[0] in (0, 1)}


def test_one_of_each_group_stays(spark, odd):
    out = run(spark, 1, odd)
    got = rows(out)
    _, component = X.jaccard_components([(r[0], r[1]) for r in X.documents()[:-2]])
    assert out.columns == COLUMNS and set(got) <= set(given())
    assert sorted(r[0] for r in got) == sorted({c for i, c in component.items() if X.words(dict((r[0], r[1]) for r in X.documents()[:-2])[i])}
                                               | {i for i, t in ((r[0], r[1]) for r in X.documents()[:-2]) if not X.words(t)})


def test_secrets_are_masked_and_the_rest_untouched(spark, odd):
    out = run(spark, 2, odd)
    assert out.columns == COLUMNS and out.count() == len(given())
    masked = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    for i, t in ((r[0], r[1]) for r in X.documents()):
        if i is not None and not X.base_secrets(t)[4]:
            assert masked[i]["text"] == t
    assert "04dbebab" not in masked[14]["text"] and "AKIA" not in masked[14]["text"] and "[SECRET]" in masked[14]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in masked.values() if r["text"] is not None)


def test_the_mixture_takes_no_row_twice(spark, odd):
    out = run(spark, 3, odd)
    got, have = rows(out), given()
    assert out.columns == COLUMNS and all(got.count(r) <= have.count(r) for r in got)
    # Texts without words cost nothing, and some of the rest stays within the budget.
    total = sum(len(X.words(r[1])) for r in have)
    assert 0 < sum(len(X.words(r[1])) for r in got) <= 0.9 * total


def test_encoding_is_exact(spark, odd):
    out = run(spark, 4, odd).collect()
    assert len(out) == len(given())
    assert all(r["exact"] for r in out if r["doc_id"] != 0)
    assert [(r["ids"], r["n_tokens"], r["exact"]) for r in out if r["doc_id"] == 0] == [(None, None, None)]
