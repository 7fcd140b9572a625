"""Hand-made fixtures (FIXTURES.md section 3): ties, NULLs, day stamps, dedupe."""

import datetime as dt

from pyspark.sql import functions as F

from clickfeat.functions import evaluation as E
from clickfeat.operators import features as FT
from clickfeat.operators import layers as L
from clickfeat.operators import metrics as M
from fixtures import BRONZE_SCHEMA, ev, silver_df, ts


def rows_by(df, *cols):
    return sorted(df.collect(), key=lambda r: tuple(str(r[c]) for c in cols))


def test_ties_share_counts_and_fan_out(spark):
    s = silver_df(spark, [
        ev(ts(5, 10), "view", "A"), ev(ts(5, 10), "cart", "B"), ev(ts(5, 11), "view", "A")])
    sm = rows_by(M.session_metrics(s), "event_time")
    assert [(r.events, r.views, r.carts) for r in sm] == [(2, 1, 1), (2, 1, 1), (3, 2, 1)]
    raw = FT.raw_features(s)
    at10 = raw.filter(F.col("event_time") == ts(5, 10)).count()
    assert at10 == 4 and raw.count() == 5
    assert FT.raw_features(s, ties="collapse").count() == 3


def test_zero_denominator_is_null(spark):
    s = silver_df(spark, [ev(ts(5, 9), "cart", "A")])
    r = M.session_metrics(s).first()
    assert r.carts_to_views is None and r.purchases_to_views is None
    assert r.purchases_to_carts == 0.0 and r.carts_to_events == 1.0


def test_quiet_day_has_null_user_metrics(spark):
    s = silver_df(spark, [ev(ts(1, 9), "view", "A"), ev(ts(3, 9), "view", "A")])
    stamps = [r.batch_time for r in rows_by(M.user_metrics(s), "batch_time")]
    assert stamps == [ts(2), ts(4)]
    raw = rows_by(FT.raw_features(s), "event_time")
    assert raw[0].user_metrics__events is None and raw[1].user_metrics__events is None


def test_day_metrics_seen_next_day(spark):
    s = silver_df(spark, [ev(ts(1, 9), "view", "A"), ev(ts(2, 9), "cart", "A")])
    raw = rows_by(FT.raw_features(s), "event_time")
    assert raw[0].user_metrics__events is None
    assert raw[1].user_metrics__events == 1 and raw[1].user_metrics__views == 1


def test_month_end_stamp(spark):
    s = silver_df(spark, [ev(dt.datetime(2021, 1, 31, 23, 59, 59), "view", "A")])
    assert M.user_metrics(s).first().batch_time == dt.datetime(2021, 2, 1)


def _bronze_rows(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def test_bad_time_dropped_utc_suffix_kept(spark):
    b = _bronze_rows(spark, [
        (1, "abc", "view", "A", "c1", None, None, "1.0", "u1", "s1"),
        (2, "2021-01-31 10:00:00 UTC", "view", "A", "c1", None, None, "1.0", "u1", "s1"),
    ])
    bronze = L.bronze(b, before="2021-02-01", carry=["event_id"])
    out = L.silver(bronze).collect()
    assert len(out) == 1 and out[0].event_time == dt.datetime(2021, 1, 31, 10)


def test_category_collision_keeps_lowest_tiebreak(spark):
    b = _bronze_rows(spark, [
        (7, "2021-01-05 10:00:00", "view", "B", "c1", None, None, "1.0", "u1", "s1"),
        (3, "2021-01-05 10:00:00", "view", "A", "c1", None, None, "1.0", "u1", "s1"),
    ])
    out = L.silver(L.bronze(b, carry=["event_id"])).collect()
    assert [r.product_id for r in out] == ["A"]


def test_null_category_dedupes_together(spark):
    b = _bronze_rows(spark, [
        (1, "2021-01-05 10:00:00", "view", "A", None, None, None, "1.0", "u1", "s1"),
        (2, "2021-01-05 10:00:00", "view", "B", None, None, None, "1.0", "u1", "s1"),
    ])
    assert L.silver(L.bronze(b, carry=["event_id"])).count() == 1


def test_null_type_dropped(spark):
    b = _bronze_rows(spark, [
        (1, "2021-01-05 10:00:00", None, "A", "c1", None, None, "1.0", "u1", "s1"),
        (2, "2021-01-05 11:00:00", "view", "A", "c1", None, None, "1.0", "u1", "s1"),
    ])
    assert L.silver(L.bronze(b, carry=["event_id"])).count() == 1


def test_null_user_kept_until_label_join(spark):
    s = silver_df(spark, [ev(ts(5, 10), "view", "A", user=None), ev(ts(5, 10), "view", "A")])
    assert M.session_metrics(s).count() == 2
    raw = FT.raw_features(s)
    assert raw.filter(F.col("user_id").isNull()).count() == 1
    nulls = raw.filter(F.col("user_id").isNull()).first()
    assert nulls.session_metrics__events is None
    fl = FT.features_and_labels(s)
    assert fl.filter(F.col("user_id").isNull()).count() == 0 and fl.count() == 1


def test_leak_view_after_purchase_carries_purchase(spark):
    s = silver_df(spark, [ev(ts(5, 10), "purchase", "A"), ev(ts(5, 11), "view", "A")])
    rows = FT.features_and_labels(s).collect()
    assert len(rows) == 1
    assert rows[0].session_metrics__purchases == 1 and rows[0].purchased == 1


def test_average_precision_hand_value(spark):
    df = spark.createDataFrame(
        [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.6), (1, 0.5)], "label int, score double")
    ap = E.average_precision(df).first().average_precision
    assert abs(ap - (1 + 2 / 3 + 3 / 5) / 3) < 1e-12  # 0.7556
    assert abs(ap - 0.7556) < 1e-4
    # Tied scores are one threshold: (1,.9),(0,.9),(1,.5) -> P=1/2 at R=1/2, P=2/3 at R=1.
    tied = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5)], "label int, score double")
    assert abs(E.average_precision(tied).first().average_precision
               - (0.5 * 0.5 + 0.5 * 2 / 3)) < 1e-12


def test_average_precision_many_ranges_matches_single_range(spark):
    import random
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), round(rng.random(), 3)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "label int, score double")
    a = E.average_precision(df, ranges=64).first().average_precision
    b = E.average_precision(df, ranges=1).first().average_precision
    assert abs(a - b) < 1e-12


def test_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 1, 0.7), (0, 0, 0.1)],
                               "label int, prediction int, score double")
    cm = E.class_metrics(df).first()
    assert cm.mcc == 0.0
    assert abs(cm.balanced_accuracy - 2 / 3) < 1e-12  # recall of the only class present
    assert E.average_precision(df).first().average_precision == 0.0


def test_class_metrics_values(spark):
    # tp=2 fp=1 tn=1 fn=1
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1), (0, 0), (1, 0)],
                               "label int, prediction int")
    cm = E.class_metrics(df).first()
    assert (cm.tp, cm.fp, cm.tn, cm.fn) == (2, 1, 1, 1)
    assert abs(cm.balanced_accuracy - 0.5 * (2 / 3 + 1 / 2)) < 1e-12
    assert abs(cm.mcc - (2 * 1 - 1 * 1) / (3 * 3 * 2 * 2) ** 0.5) < 1e-12


def test_expand_large_copies_in_chunks(spark):
    df = spark.createDataFrame([(1, 25_001), (2, 1), (3, 10_000)], "k int, _copies bigint")
    counts = {r.k: r["count"] for r in FT.expand(df).groupBy("k").count().collect()}
    assert counts == {1: 25_001, 2: 1, 3: 10_000}
