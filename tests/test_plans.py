"""Plan-shape checks for the scale design (no regressions to gathering plans)."""

import datetime as dt

from clickfeat.operators import features as FT
from clickfeat.operators import metrics as M
from clickfeat.operators.running import SLICE, Slicing, add_slices, group_cols
from fixtures import ev, silver_df
from pyspark.sql import functions as F

T0 = dt.datetime(2021, 1, 4)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark, hot_session_events=3000):
    rows = [ev(T0 + dt.timedelta(seconds=7 * i), "view", "A", user="hot", session="s1")
            for i in range(hot_session_events)]
    rows += [ev(T0 + dt.timedelta(hours=i), "cart", "B", user=f"u{i}", session=f"s{i}")
             for i in range(20)]
    return silver_df(spark, rows)


def _shape(plan: str) -> tuple[int, int, int, int]:
    return tuple(plan.count(x) for x in ("REPARTITION_BY_COL", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin"))


def test_model_queries_run_the_full_budgets():
    from clickfeat.plans import model, queries

    assert queries.FULL == (model.MAX_ITER, model.MAX_EVALS) == (100, 25)


def test_one_plan_with_one_event_exchange_at_every_size(spark):
    shapes = set()
    for n, hot in ((10, 2_000_000), (3000, 100)):
        s = _rows(spark, n)
        for df in (M.session_metrics(s, slicing=Slicing(hot_rows=hot)),
                   FT.with_session_features(FT.feature_base(s), FT.SESSION_LEVELS, Slicing(hot_rows=hot), label=True)):
            shapes.add((len(df.columns), _shape(_plan(df))))
    assert len(shapes) == 2                      # the same for both sizes
    for _, (exchanges, merge, hashed, _) in shapes:
        assert (exchanges, merge, hashed) == (1, 0, 0)


def test_running_rows_carry_each_key_once(spark):
    plan = FT.running_events(_rows(spark, 10))._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "RepartitionByExpression" in x)
    union = plan[plan.index(line):].splitlines()[1:]
    first = next(x for x in union if "Project" in x)
    assert "_g_user_id" in first and "user_id AS user_id" not in first
    assert first.count("_off_") <= 8            # four columns, named once or aliased


def test_hot_session_day_is_cut_finer(spark):
    s = _rows(spark)
    keyed = s.selectExpr("*", "coalesce(user_id, '') AS _g_user_id", "user_id IS NULL AS _z_user_id",
                         "coalesce(user_session, '') AS _g_user_session",
                         "user_session IS NULL AS _z_user_session")
    for hot, least in ((1000, 300), (5, 2500)):   # 3000 events 7 s apart: ~350 minutes
        sliced = add_slices(keyed, ["user_id", "user_session"], "event_time", Slicing(hot_rows=hot))
        per_key = {r.user_id: (r.n, r.most) for r in sliced.groupBy("user_id", SLICE).count()
                   .groupBy("user_id").agg(F.count("*").alias("n"), F.max("count").alias("most")).collect()}
        assert per_key["hot"][0] > least and per_key["hot"][1] <= hot
        assert all(n == 1 for u, (n, _) in per_key.items() if u != "hot")
    assert len(group_cols(["user_id"])) == 2


def test_ten_thousand_ties_stay_one_row_each(spark):
    rows = [ev(T0, "view", "A", user="u", session="s") for _ in range(10_000)]
    out = FT.features_and_labels(silver_df(spark, rows), ties="weight")
    assert out.selectExpr("count(*) AS n", "sum(_copies) AS c").first() == (10_000, 10_000 ** 3)


def test_sessions_come_from_one_aggregate(spark):
    from clickfeat.operators import split as S

    plan = _plan(S.training_sessions(_rows(spark)))
    assert not any(x in plan for x in ("Window", "Generate", "Join"))


def test_daily_sets_share_one_aggregation(spark):
    s = _rows(spark)
    df = FT.raw_features(s)
    df.collect()  # the adaptive plan is final once its own execution ran
    final = _plan(df).split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2
