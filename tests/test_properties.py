"""Properties against brute force on random small tables (hypothesis)."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from clickfeat.functions.ratios import COUNTS
from clickfeat.operators import features as FT
from clickfeat.operators import metrics as M
from clickfeat.operators import split as S
from clickfeat.operators.running import Slicing
from fixtures import ev, silver_df

T0 = dt.datetime(2021, 1, 4)

event = st.tuples(
    st.integers(0, 3 * 24 * 60 - 1).map(lambda m: T0 + dt.timedelta(minutes=m // 7 * 7)),
    st.sampled_from(["view", "cart", "purchase", "remove"]),
    st.sampled_from(["A", "B", "C"]),
    st.sampled_from(["u1", "u2", None]),
    st.sampled_from(["s1", "s2"]),
)
events = st.lists(event, min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None,
                    phases=[Phase.explicit, Phase.reuse, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def canon(rows):
    """Rows with timestamps as pandas Timestamps, in a stable order."""
    fixed = [tuple(pd.Timestamp(v) if isinstance(v, dt.datetime) else v for v in r) for r in rows]
    return sorted(fixed, key=lambda r: tuple(str(v) for v in r))


def brute_running(rows, keys):
    pdf = pd.DataFrame(rows, columns=["event_time", "event_type", "product_id", "user_id",
                                      "user_session"])
    out = []
    for _, r in pdf.iterrows():
        same = pd.Series(True, index=pdf.index)
        for k in keys:
            same &= (pdf[k] == r[k]) | (pdf[k].isna() & pd.isna(r[k]))
        prior = pdf[same & (pdf.event_time <= r.event_time)]
        out.append((*[r[k] for k in keys], r.event_time, len(prior),
                    int((prior.event_type == "view").sum()),
                    int((prior.event_type == "cart").sum()),
                    int((prior.event_type == "purchase").sum())))
    return canon(out)


def to_silver(spark, rows):
    return silver_df(spark, [ev(t, typ, p, user=u, session=s) for t, typ, p, u, s in rows])


@SETTINGS
@given(rows=events, unit=st.sampled_from(["minute", "hour", "day"]),
       fine=st.sampled_from(["minute", "hour"]), hot=st.sampled_from([0, 1, 3, 10 ** 9]))
def test_running_metrics_equal_brute_force(spark, rows, unit, fine, hot):
    s = to_silver(spark, rows)
    slicing = Slicing(unit=unit, finer=(fine, "instant"), hot_rows=hot)
    for keys, fn in ((M.SESSION_KEYS, M.session_metrics),
                     (M.PRODUCT_SESSION_KEYS, M.product_session_metrics)):
        got = canon((*[r[k] for k in keys], r.event_time, *[r[c] for c in COUNTS])
                    for r in fn(s, slicing=slicing).collect())
        assert got == brute_running(rows, list(keys))


@SETTINGS
@given(rows=events)
def test_fan_out_and_label_properties(spark, rows):
    s = to_silver(spark, rows)
    pdf = pd.DataFrame(rows, columns=["t", "typ", "p", "u", "s"]).fillna({"u": "<null>"})
    n_s = pdf.groupby(["u", "s", "t"])["p"].transform("size")
    n_ps = pdf.groupby(["u", "s", "p", "t"])["p"].transform("size")
    copies = (n_s * n_ps).where(pdf.u != "<null>", 1)
    assert FT.raw_features(s).count() == int(copies.sum())
    assert FT.raw_features(s, ties="collapse").count() == len(rows)
    labels = {(r.user_id, r.user_session, r.product_id): r.purchased
              for r in FT.session_product_outcomes(s).collect()}
    for (u, sess, p), flag in labels.items():
        bought = any(x[3] == u and x[4] == sess and x[2] == p and x[1] == "purchase"
                     for x in rows)
        assert flag == int(bought)


@SETTINGS
@given(rows=events)
def test_counts_monotone_and_bounded(spark, rows):
    s = to_silver(spark, rows)
    for r in M.session_metrics(s).collect():
        assert r.views + r.carts + r.purchases <= r.events
    daily = M.user_metrics(s).toPandas().sort_values(["user_id", "batch_time"])
    for _, g in daily.groupby(daily.user_id.fillna("<null>")):
        assert g.events.is_monotonic_increasing
    totals = pd.DataFrame(rows, columns=["t", "typ", "p", "u", "s"]).fillna({"u": "<null>"})
    last = daily.groupby(daily.user_id.fillna("<null>")).events.max()
    assert last.to_dict() == totals.groupby("u").size().to_dict()


def test_hot_session_across_many_slices(spark):
    # One session holds most rows and spans many slices; others are small.
    rows = [(T0 + dt.timedelta(minutes=3 * i), ["view", "cart", "purchase"][i % 3], "A",
             "hot", "s1") for i in range(600)]
    rows += [(T0 + dt.timedelta(hours=i), "view", "B", "cold", "s9") for i in range(5)]
    s = to_silver(spark, rows)
    expected = brute_running(rows, list(M.SESSION_KEYS))
    for slicing in (Slicing(unit="minute", hot_rows=10**9),  # every key cut finely
                    Slicing(unit="day", hot_rows=100),       # hot session-days cut finely
                    Slicing(unit="day", hot_rows=2)):         # down to instants
        got = canon((r.user_id, r.user_session, r.event_time, *[r[c] for c in COUNTS])
                    for r in M.session_metrics(s, slicing=slicing).collect())
        assert got == expected


def test_splits_disjoint_and_cover(spark):
    rows = [(f"u{i % 37}", f"s{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "user_id string, user_session string")
    parts = {p: {tuple(r) for r in S.split_rows(df, p, keep_keys=True).collect()}
             for p in ("train", "test", "validate", "train_test")}
    assert not parts["train"] & parts["test"] and not parts["train"] & parts["validate"]
    assert not parts["test"] & parts["validate"]
    assert parts["train"] | parts["test"] | parts["validate"] == set(rows)
    assert parts["train_test"] == parts["train"] | parts["test"]


def test_repeatable_across_shuffle_partitions(spark):
    from oracle import frame_digest
    from clickfeat.plans.queries import q_features_and_labels
    sf = "/root/testdata/sf0.001"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = frame_digest(q_features_and_labels(spark, sf).toPandas())
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = frame_digest(q_features_and_labels(spark, sf).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


bronze_row = st.tuples(
    st.integers(0, 5).map(lambda h: f"2021-01-05 {10 + h:02d}:00:00"),
    st.sampled_from(["view", "cart", "purchase", None]),
    st.sampled_from(["A", "B", "C"]),
    st.sampled_from(["c1", "c2", None]),
    st.sampled_from(["u1", "u2", None]),
    st.sampled_from(["s1", "s2", None]),
)


@SETTINGS
@given(rows=st.lists(bronze_row, min_size=1, max_size=30))
def test_silver_dedupe_keeps_lowest_tiebreak(spark, rows):
    from clickfeat.operators import layers as L
    from fixtures import BRONZE_SCHEMA

    data = [(i, t, typ, p, c, None, None, "1.0", u, s)
            for i, (t, typ, p, c, u, s) in enumerate(rows)]
    bronze = spark.createDataFrame(data, BRONZE_SCHEMA)
    def order(t):
        return tuple((v is None, str(v)) for v in t)

    got = sorted(((str(r.event_time), r.event_type, r.category_id, r.user_session, r.product_id,
                   r.user_id) for r in L.silver(L.bronze(bronze, carry=["event_id"])).collect()),
                 key=order)
    kept = {}
    for i, t, typ, p, c, _, _, _, u, s in data:
        if typ is None or s is None:
            continue  # dropped: required column missing
        key = (t, typ, c, s)
        if key not in kept or i < kept[key][0]:
            kept[key] = (i, p, u)
    want = sorted(((t, typ, c, s, p, u) for (t, typ, c, s), (_, p, u) in kept.items()), key=order)
    assert got == want
