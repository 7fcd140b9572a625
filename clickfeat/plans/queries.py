"""The query catalogue: one callable per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver ``events`` table of ``sf_dir`` through the
adapter and states its result with the library's operators; nothing is cut
to a subset of rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.functions import evaluation as E
from clickfeat.operators import features as FT
from clickfeat.operators import layers as L
from clickfeat.operators import metrics as M
from clickfeat.operators import split as S
from clickfeat.operators.running import Slicing
from clickfeat.plans import model as ML
from clickfeat.session import fresh_dir, prepare
from clickfeat.sources.events import (NATIVE_COLUMNS, TIEBREAK, as_csv_strings,
                                      from_driver_events)
from clickfeat.sources.tables import materialize, read_table, write_table
from clickfeat.streaming.ingest import ingest, read_staging

Query = Callable[[SparkSession, str], DataFrame]

# The bronze query's cutoff on the driver data (the reference's own cutoff,
# 2021-02-01, precedes every driver event); all other queries use none.
BRONZE_CUTOFF = dt.datetime(2024, 1, 22)


def staging(spark: SparkSession, sf_dir: str, before: dt.datetime | None = None) -> DataFrame:
    return from_driver_events(prepare(spark), sf_dir, before=before)


def silver_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.silver(L.bronze(staging(spark, sf_dir), carry=[TIEBREAK]), tiebreak=[TIEBREAK])


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once to the work folder and read back: the queries
    below use it in several branches, which would otherwise each redo the
    scan and the dedupe shuffle."""
    return materialize(spark, silver_plan(spark, sf_dir), fresh_dir(spark, "silver"))


def q_bronze_events(spark, sf_dir):
    return L.bronze(staging(spark, sf_dir, BRONZE_CUTOFF), before=BRONZE_CUTOFF)


def q_silver_cast(spark, sf_dir):
    # Staging as a CSV loader presents it (strings), then the typed projection.
    as_text = as_csv_strings(L.bronze(staging(spark, sf_dir)))
    return L.silver_cast(as_text)


def q_silver_dropna(spark, sf_dir):
    return L.silver_dropna(L.silver_cast(L.bronze(staging(spark, sf_dir))))


def q_silver_events(spark, sf_dir):
    return silver_plan(spark, sf_dir)


def q_session_metrics(spark, sf_dir):
    return M.session_metrics(silver_of(spark, sf_dir))


def q_product_session_metrics(spark, sf_dir):
    return M.product_session_metrics(silver_of(spark, sf_dir))


def q_user_daily_counts(spark, sf_dir):
    return M.daily_counts(silver_plan(spark, sf_dir), ["user_id"])


def q_user_metrics(spark, sf_dir):
    return M.user_metrics(silver_plan(spark, sf_dir))


def q_product_metrics(spark, sf_dir):
    return M.product_metrics(silver_plan(spark, sf_dir))


def q_user_product_metrics(spark, sf_dir):
    return M.user_product_metrics(silver_plan(spark, sf_dir))


def q_metrics_prefixed(spark, sf_dir):
    table = "user_product_metrics"
    return FT.prefixed(M.user_product_metrics(silver_plan(spark, sf_dir)), table,
                       M.METRIC_TABLES[table])


def _single_join(table: str) -> Query:
    def run(spark, sf_dir):
        silver = silver_of(spark, sf_dir)
        base = FT.feature_base(silver)
        if table in FT.SESSION_LEVELS:
            out = FT.with_session_features(base, {table: FT.SESSION_LEVELS[table]})
            return FT.expand(out)
        return FT.attach(base, FT.daily_frames(silver)[table], table)
    run.__name__ = f"q_join_{table}"
    return run


def q_raw_features(spark, sf_dir):
    return FT.raw_features(silver_of(spark, sf_dir), ties="multiply")


def q_raw_features_collapsed(spark, sf_dir):
    return FT.raw_features(silver_of(spark, sf_dir), ties="collapse")


def q_session_product_outcomes(spark, sf_dir):
    return FT.session_product_outcomes(silver_plan(spark, sf_dir))


def q_raw_features_and_labels(spark, sf_dir):
    return FT.raw_features_and_labels(silver_of(spark, sf_dir))


def q_features_and_labels(spark, sf_dir):
    return FT.features_and_labels(silver_of(spark, sf_dir))


def q_sessions_distinct(spark, sf_dir):
    return S.training_sessions(silver_plan(spark, sf_dir))


def q_session_split(spark, sf_dir):
    return S.session_split(S.training_sessions(silver_plan(spark, sf_dir)))


def _split(part: str) -> Query:
    def run(spark, sf_dir):
        return S.split_rows(q_features_and_labels(spark, sf_dir), part)
    run.__name__ = f"q_split_{part}"
    return run


# Deterministic stand-in score for the metric queries (no model involved):
# the product's running cart share in the session so far.
def _scored(spark, sf_dir, ties: str):
    """(label, score, copies) written to the work folder: average precision reads
    it twice (quantile cut points, then the sums). It needs the session levels
    and the label only, not the day-level sets."""
    base = FT.with_session_features(FT.feature_base(silver_of(spark, sf_dir)), FT.SESSION_LEVELS, label=True)
    rows = base.filter(f"{FT.LABEL} IS NOT NULL AND event_type != 'purchase'") \
               .selectExpr(f"{FT.LABEL} AS label", "coalesce(product_session_metrics__carts_to_events, 0.0) AS score", FT.COPIES)
    return materialize(spark, FT.expand(rows, ties), fresh_dir(spark, "scored"))


def _class_metrics(scored, weight: str | None = None):
    predicted = scored.withColumn("prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0))
    return E.class_metrics(predicted, digits=6, weight_col=weight)


def q_class_metrics(spark, sf_dir):
    return _class_metrics(_scored(spark, sf_dir, "multiply"))


def q_class_metrics_weighted(spark, sf_dir):
    return _class_metrics(_scored(spark, sf_dir, "weight"), FT.COPIES)


def q_average_precision(spark, sf_dir):
    return E.average_precision(_scored(spark, sf_dir, "multiply"), digits=6)


def q_average_precision_weighted(spark, sf_dir):
    return E.average_precision(_scored(spark, sf_dir, "weight"), digits=6, weight_col=FT.COPIES)


def skewed(staged):
    """Staged events of which a third are moved to one user, and so to few sessions."""
    hot = F.pmod(F.col(TIEBREAK), F.lit(3)) == 0
    return staged.withColumns({"user_id": F.when(hot, "0").otherwise(F.col("user_id")),
                               "user_session": F.when(hot, "0-hot").otherwise(F.col("user_session"))})


def q_session_metrics_skewed(spark, sf_dir):
    """A third of all events in one session, its days and hours cut finer as hot groups are."""
    hot = L.silver(L.bronze(skewed(staging(spark, sf_dir)), carry=[TIEBREAK]), tiebreak=[TIEBREAK])
    silver = materialize(spark, hot, fresh_dir(spark, "silver"))
    return M.session_metrics(silver, Slicing(hot_rows=20, most_hot=50_000))


# Two CSV drops of the driver events: before and from this instant.
DROP_SPLIT = dt.datetime(2024, 1, 15)
# NULL times are in the second drop, so that every row is in one of them.
IN_DROP_A = f"coalesce(event_time < '{DROP_SPLIT:%Y-%m-%d %H:%M:%S}', false)"


def q_stream_ingest(spark, sf_dir):
    """Drop A, drain; drop B, drain; drain again (no new files): staging holds
    every event exactly once. Returns the business columns, typed."""
    base = fresh_dir(spark, "stream")
    raw, staged, ckpt = f"{base}/raw", f"{base}/staging", f"{base}/checkpoint"
    text = as_csv_strings(L.bronze(staging(spark, sf_dir))).select(*NATIVE_COLUMNS)
    for name, rows in (("drop_a", text.filter(IN_DROP_A)), ("drop_b", text.filter(f"NOT {IN_DROP_A}"))):
        rows.write.option("header", True).csv(f"{raw}/{name}")
        ingest(spark, f"{raw}/*", staged, ckpt)
    ingest(spark, f"{raw}/*", staged, ckpt)
    return L.silver_cast(read_staging(spark, staged, ckpt).select(*NATIVE_COLUMNS))


def q_stream_evolve(spark, sf_dir):
    """A second drop with a further column and the columns reversed: matched by
    name, the new column NULL for the first drop; lineage columns are set."""
    base = fresh_dir(spark, "stream")
    raw, staged, ckpt = f"{base}/raw", f"{base}/staging", f"{base}/checkpoint"
    text = as_csv_strings(L.bronze(staging(spark, sf_dir))).select(*NATIVE_COLUMNS)
    wide = text.withColumn("campaign", F.concat(F.lit("c"), F.col("product_id")))
    wide = wide.select(*reversed(wide.columns))
    for name, rows in (("drop_a", text.filter(IN_DROP_A)), ("drop_b", wide.filter(f"NOT {IN_DROP_A}"))):
        rows.write.option("header", True).csv(f"{raw}/{name}")
        ingest(spark, f"{raw}/*", staged, ckpt)
    rows = read_staging(spark, staged, ckpt)
    return L.silver_cast(rows.select(*NATIVE_COLUMNS, "campaign", "source_file", "processing_time")).select(
        *NATIVE_COLUMNS, "campaign",
        F.regexp_extract("source_file", "/(drop_[ab])/[^/]*[.]csv$", 1).alias("drop"),
        (F.col("processing_time") > F.lit("2020-01-01").cast("timestamp")).alias("stamped"))


def q_table_roundtrip(spark, sf_dir):
    """Silver written as an external catalog table, read back by name."""
    path = fresh_dir(spark, "tables")
    name = "silver_events_" + path.rsplit("-", 1)[-1].replace("-", "")[:12]
    write_table(silver_plan(spark, sf_dir), name, f"{path}/silver/events")
    return read_table(spark, name)


def _training_table(spark, sf_dir):
    """The weighted training table (one row an event) written to the work folder."""
    f = FT.features_and_labels(silver_of(spark, sf_dir), ties="weight")
    return materialize(spark, f, fresh_dir(spark, "training"))


# The single fit's parameters.
QUERY_PARAMS = ML.Params(max_depth=3, learning_rate=0.1, scale_pos_weight=2.0)


# The library's full budgets; only the tests set a smaller number of rounds (tests/conftest.py).
ROUNDS, TRIALS = ML.MAX_ITER, ML.MAX_EVALS
MODEL = "purchase_intent"
SEARCH_SEED = 1
DIGITS = 9     # of the metrics that a statement repeats


def _test_rows(f):
    """The test split with one row for each copy."""
    return FT.expand(S.split_rows(f, "test", keep_keys=True), "multiply")


def q_train_and_score(spark, sf_dir):
    """A fitted model's classes and probabilities on the test split, as facts that
    hold for any right fit, and that it ranks the rows better than chance."""
    f = _training_table(spark, sf_dir)
    model = ML.fit(S.split_rows(f, "train"), QUERY_PARAMS, max_iter=ROUNDS)
    return _checked(ML.predict(model, _test_rows(f)))


def _checked(scored):
    """Row facts, and two of the whole split: a useless or inverted model's average
    precision is about the base rate, a constant class's MCC is 0."""
    spark = scored.sparkSession
    scored = materialize(spark, scored, fresh_dir(spark, "predictions"))
    p = F.col(ML.PROBABILITY)
    m = ML.measured(scored.select(F.col(FT.LABEL).alias("label"), "prediction", p.alias("score"), F.lit(1).alias("copies")))
    base = scored.agg(F.avg(FT.LABEL)).first()[0] or 0.0
    return scored.select(
        "user_id", "user_session", FT.LABEL, F.col("prediction").isin(0, 1).alias("binary"),
        p.between(0.0, 1.0).alias("in_range"),
        ((F.col("prediction") == 1) == (p > 0.5)).alias("agrees"),
        F.lit(m["average_precision"] > base).alias("ranks"), F.lit(m["mcc"] > 0).alias("separates"))


def formula_scores(rows, p: ML.Params):
    """A model-free stand-in for a fit, which a statement can repeat exactly: two running
    cart shares mixed by the rate and cut to steps; the weight moves the class's threshold."""
    mixed = (f"{p.learning_rate!r}D * coalesce(product_session_metrics__carts_to_events, 0.0D)"
             f" + (1D - {p.learning_rate!r}D) * coalesce(session_metrics__carts_to_events, 0.0D)")
    scored = rows.selectExpr(f"{FT.LABEL} AS label", f"floor(({mixed}) * {p.max_depth + 1}) / {p.max_depth + 1} AS score",
                             f"{FT.COPIES} AS copies")
    return scored.selectExpr("*", f"if(score * {p.scale_pos_weight!r}D >= 1D - score, 1, 0) AS prediction")


def _trials(spark, f):
    """All trials of the search, each one measured by the formula."""
    return ML.tune(spark, S.split_rows(f, "train"), S.split_rows(f, "test"), max_evals=TRIALS, seed=SEARCH_SEED, run_id="query",
                   journal=fresh_dir(spark, "trials"),
                   objective=lambda _, test, p: ML.measured(formula_scores(test, p), DIGITS))


def q_tuning_trials(spark, sf_dir):
    """Every trial of the search: its parameters, and what its objective measured."""
    return _trials(spark, _training_table(spark, sf_dir)).drop("logged_at")


def q_best_trial(spark, sf_dir):
    """The parameters of the trial with the highest average precision."""
    best = ML.best_params(_trials(spark, _training_table(spark, sf_dir)))
    return spark.createDataFrame([(best.max_depth, best.learning_rate, best.scale_pos_weight)],
                                 "max_depth int, learning_rate double, scale_pos_weight double")


def _measured(f, part: str) -> dict:
    return ML.measured(formula_scores(S.split_rows(f, part), QUERY_PARAMS), DIGITS)


def _trained(spark, f) -> str:
    """A registry with the whole training task: the search over fits, the refit, its metrics and the version."""
    registry = fresh_dir(spark, "registry")
    ML.train(spark, f, registry, MODEL, max_evals=TRIALS, max_iter=ROUNDS, run_id="query")
    return registry


def q_training_runs(spark, sf_dir):
    """The metrics of two splits that the whole training logs, as facts that hold for any
    right fit, and the formula's on the same splits, as numbers; logged to a registry and read from it."""
    f = _training_table(spark, sf_dir)
    registry = _trained(spark, f)
    for part in ("train_test", "validate"):
        ML.log_run(spark, registry, "formula", part, _measured(f, part), "query")
    names, formula = ("average_precision", "balanced_accuracy", "mcc"), F.col("run") == "formula"
    return ML.runs(spark, registry).select(
        "run", "split", "run_id", *[F.when(formula, F.col(c)).alias(c) for c in names],
        *[F.coalesce(F.col(c).between(-1.0 if c == "mcc" else 0.0, 1.0), F.lit(False)).alias(f"{c}_ok") for c in names])


def _registered(spark, f, times: int) -> str:
    """A registry with the same fit, ``times`` times."""
    registry = fresh_dir(spark, "registry")
    model = ML.fit(S.split_rows(f, "train_test"), QUERY_PARAMS, max_iter=ROUNDS)
    metrics = _measured(f, "validate")
    for _ in range(times):
        ML.register(spark, model, registry, MODEL, metrics, run_id="query")
    return registry


def q_model_latest(spark, sf_dir):
    """Every version with its metrics; the newest is in production."""
    registry = _registered(spark, _training_table(spark, sf_dir), 2)
    newest = ML.latest_version(spark, registry, MODEL).select("name", "version", F.lit(True).alias("newest"))
    return ML.versions(spark, registry).join(newest, ["name", "version"], "left").select(
        "name", "version", "stage", "average_precision", "balanced_accuracy", "mcc", "run_id",
        F.coalesce("newest", F.lit(False)).alias("newest"))


def q_score_production(spark, sf_dir):
    """The production model, made by the whole training, on the validate split's rows."""
    f = _training_table(spark, sf_dir)
    rows = FT.expand(S.split_rows(f, "validate", keep_keys=True), "multiply")
    return _checked(ML.score(spark, rows, _trained(spark, f), MODEL))


def catalogue() -> dict[str, Query]:
    q: dict[str, Query] = {
        "bronze_events": q_bronze_events,
        "silver_cast": q_silver_cast,
        "silver_dropna": q_silver_dropna,
        "silver_events": q_silver_events,
        "session_metrics": q_session_metrics,
        "product_session_metrics": q_product_session_metrics,
        "user_daily_counts": q_user_daily_counts,
        "user_metrics": q_user_metrics,
        "product_metrics": q_product_metrics,
        "user_product_metrics": q_user_product_metrics,
        "metrics_prefixed": q_metrics_prefixed,
        "join_session": _single_join("session_metrics"),
        "join_product_session": _single_join("product_session_metrics"),
        "join_user": _single_join("user_metrics"),
        "join_product": _single_join("product_metrics"),
        "join_user_product": _single_join("user_product_metrics"),
        "raw_features": q_raw_features,
        "raw_features_collapsed": q_raw_features_collapsed,
        "session_product_outcomes": q_session_product_outcomes,
        "raw_features_and_labels": q_raw_features_and_labels,
        "features_and_labels": q_features_and_labels,
        "sessions_distinct": q_sessions_distinct,
        "session_split": q_session_split,
    }
    for part in S.SPLITS:
        q[f"split_{part}"] = _split(part)
    q["class_metrics"] = q_class_metrics
    q["class_metrics_weighted"] = q_class_metrics_weighted
    q["average_precision"] = q_average_precision
    q["average_precision_weighted"] = q_average_precision_weighted
    q["session_metrics_skewed"] = q_session_metrics_skewed
    q["stream_ingest"] = q_stream_ingest
    q["stream_evolve"] = q_stream_evolve
    q["table_roundtrip"] = q_table_roundtrip
    q["train_and_score"] = q_train_and_score
    q["tuning_trials"] = q_tuning_trials
    q["best_trial"] = q_best_trial
    q["model_latest"] = q_model_latest
    q["training_runs"] = q_training_runs
    q["score_production"] = q_score_production
    return q
