"""A third of all events in one session: results still equal the oracle.

The skewed table is derived from the driver events (rows with event_id % 3 == 0
move to user 0 and into the first six days, i.e. one session). Slicing is set so
that this session's days count as hot and are cut into minute slices.
"""

import duckdb
import pytest

from clickfeat.oracle_sql import queries as oracle_queries
from clickfeat.operators import features as FT
from clickfeat.operators import layers as L
from clickfeat.operators import metrics as M
from clickfeat.operators.running import Slicing
from clickfeat.sources.events import TIEBREAK, from_driver_events
from oracle import compare

SOURCE = "/root/testdata/sf0.01/events.parquet"
HOT = Slicing(hot_rows=20)


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("skewed")
    duckdb.connect().execute(f"""
        COPY (
          SELECT event_id,
                 CASE WHEN event_id % 3 = 0
                      THEN TIMESTAMP '2024-01-01' + to_microseconds(epoch_us(ts) % (6 * 86400000000))
                      ELSE ts END AS ts,
                 CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
                 event_type, value, props
          FROM read_parquet('{SOURCE}')
        ) TO '{d}/events.parquet' (FORMAT PARQUET)""")
    # The oracle helper registers every driver table; the others are unused.
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        (d / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.01/{t}.parquet")
    return str(d)


def _silver(spark, sf_dir):
    return L.silver(L.bronze(from_driver_events(spark, sf_dir), carry=[TIEBREAK]),
                    tiebreak=[TIEBREAK])


def test_hot_session_exists(spark, skewed_dir):
    silver = _silver(spark, skewed_dir)
    sizes = [r["count"] for r in silver.groupBy("user_id", "user_session").count()
             .orderBy("count", ascending=False).limit(2).collect()]
    # A third of the raw events; after the dedupe (which collapses copies in
    # the session's hours) still about a quarter of silver, 30x the next one.
    assert sizes[0] > 0.2 * silver.count() and sizes[0] > 30 * sizes[1]


@pytest.mark.parametrize("name", ["session_metrics", "product_session_metrics",
                                  "features_and_labels"])
def test_skewed_results_match_oracle(spark, skewed_dir, name):
    silver = _silver(spark, skewed_dir)
    df = {"session_metrics": lambda: M.session_metrics(silver, HOT),
          "product_session_metrics": lambda: M.product_session_metrics(silver, HOT),
          "features_and_labels": lambda: FT.features_and_labels(silver, slicing=HOT)}[name]()
    r = compare(df, oracle_queries()[name], skewed_dir)
    assert r["rows_spark"] == r["rows_oracle"]
    assert r["hash_match"]
