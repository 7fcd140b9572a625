"""Feature assembly: point-in-time metric sets, labels and the training table.

Every event gets the five metric sets that were known at its time:

* session and session x product running metrics at its exact ``event_time``
  (computed on the events themselves, ``clickfeat.operators.running``);
* user, product and user x product day-level metrics stamped with the
  event's own day (made the day before, so no same-day leakage), attached
  by N:1 left joins to the distinct (user, product, day) keys, which the
  events then join once.

Tie fan-out (Q3). The reference joins per-event metric tables, whose keys
repeat for events tied on time, so an event is emitted ``n_s x n_ps`` times
(n_s events share its user, session and instant; n_ps also its product).
Here those counts are window counts carried as ``_copies``, and the copies
are made by one ``explode`` at the very end (``ties="multiply"``, the
reference's rows). ``ties="weight"``: one row per event, ``_copies`` kept as its
weight for fits, scores and splits. ``ties="collapse"``: one row per event.
A NULL user matches no per-session row in the reference's joins: its
session features are NULL and it is not multiplied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.ratios import METRICS, PURCHASE
from clickfeat.functions.sqlexpr import as_, cols, project, q
from clickfeat.operators import metrics as M
from clickfeat.operators.running import SLICING, Slicing, level_columns, with_running

# The event columns kept in the raw feature table, in the
# order left by the chain of USING joins, and the label key.
EVENT_COLUMNS = ("user_id", "product_id", "batch_time", "user_session", "event_time", "event_type")
LABEL_KEYS = ("user_id", "user_session", "product_id")
LABEL = "purchased"
DROPPED_FOR_TRAINING = ("event_type", "product_id", "event_time", "batch_time")
COPIES = "_copies"
EXPAND_CHUNK = 10_000
TIES = "_ties"  # per-level tie counts left by with_running: _ties__<level>

FEATURES = tuple(f"{t}__{m}" for t in M.METRIC_TABLES for m in METRICS)


def prefixed(metrics_df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keep the keys, rename every other column to ``<table>__<col>``."""
    renamed = [as_(q(c), f"{table}__{c}") for c in metrics_df.columns if c not in keys]
    return project(metrics_df, [*cols(keys), *renamed])


SESSION_LEVELS = {
    "session_metrics": M.SESSION_KEYS,
    "product_session_metrics": M.PRODUCT_SESSION_KEYS,
}
DAILY_TABLES = ("user_metrics", "product_metrics", "user_product_metrics")


def daily_frames(silver: DataFrame, up: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three day-level metric sets, each with one row per join key.

    The events are aggregated once, per (user, product, day) -- or ``up``
    supplies that aggregate, e.g. read back from a table; the user and
    product day counts are roll-ups of it.
    """
    up = up if up is not None else M.daily_counts(silver, ["user_id", "product_id"])
    # These sets are only joined on plain equality, where a NULL key matches
    # nothing; dropping NULL keys once keeps the three branches one plan, so
    # the day aggregation is computed (and exchanged) once, not per join.
    up = up.filter("user_id IS NOT NULL AND product_id IS NOT NULL")
    return {
        "user_metrics": M.cumulative(M.rollup_daily(up, ["user_id"]), ["user_id"]),
        "product_metrics": M.cumulative(M.rollup_daily(up, ["product_id"]), ["product_id"]),
        "user_product_metrics": M.cumulative(up, ["user_id", "product_id"]),
    }


def feature_base(silver: DataFrame) -> DataFrame:
    """The events to describe, stamped with their own day."""
    return project(silver, ["user_id", "user_session", "product_id", "event_time", "event_type",
                            "date_trunc('day', event_time) AS batch_time"])


def attach(base: DataFrame, metrics_df: DataFrame, table: str) -> DataFrame:
    """Left join one metric set by its keys (plain equality, so a
    NULL user matches nothing). ``metrics_df`` has one row per key.

    The planner picks the join from measured sizes (AQE).
    """
    keys = list(M.METRIC_TABLES[table])
    side = prefixed(metrics_df, table, keys)
    return base.join(side, on=keys, how="left")


def with_session_features(base: DataFrame, levels: Mapping[str, Sequence[str]],
                          slicing: Slicing = SLICING, label: bool = False) -> DataFrame:
    """Attach running session-level metric sets and ``_copies``.

    With ``label``, also ``purchased`` (O33/O74) for the event's
    (user, session, product); rows that would find no label (NULL user,
    Q8) get NULL there.
    """
    outcome = "product_session_metrics" if label else None
    r = with_running(base, levels, slicing=slicing, outcome_level=outcome)
    return session_features(r, levels, base.columns, label)


def running_events(silver: DataFrame, slicing: Slicing = SLICING) -> DataFrame:
    """Every event with both session levels' running metrics, tie counts and
    label: computed once, projected to the metric tables and the features."""
    return with_running(feature_base(silver), SESSION_LEVELS, slicing=slicing,
                        outcome_level="product_session_metrics")


def session_features(running: DataFrame, levels: Mapping[str, Sequence[str]],
                     base_columns: Sequence[str], label: bool) -> DataFrame:
    """The columns of ``with_session_features`` from events that have the metrics."""
    matched = "user_id IS NOT NULL"
    copies = " * ".join(q(f"{TIES}__{n}") for n in levels)
    out = [*cols(base_columns)]
    out += [as_(f"CASE WHEN {matched} THEN {q(c)} END", c)
            for n in levels for c in level_columns(n)]
    out.append(as_(f"CASE WHEN {matched} THEN {copies} ELSE 1 END", COPIES))
    if label:
        out.append(as_(f"CASE WHEN {matched} THEN {LABEL} END", LABEL))
    return project(running, out)


def expand(df: DataFrame, ties: str = "multiply") -> DataFrame:
    """Emit each row ``_copies`` times (multiply), once (collapse), or once
    with ``_copies`` as its weight (weight)."""
    if ties == "weight":
        return df
    if ties == "collapse":
        return df.drop(COPIES)
    if ties != "multiply":
        raise ValueError(f"ties must be 'multiply', 'weight' or 'collapse', not {ties!r}")
    # Rows of up to EXPAND_CHUNK copies are written where they are. Only those
    # with more take two levels (chunks, then the copies of a chunk), so that no
    # generated array grows with the tie-group size squared, and only their
    # chunks are dealt out evenly between the two, so that no task has to
    # write all copies of a large group. ``weight`` avoids the copies.
    rest = [c for c in df.columns if c != COPIES]
    n, b = q(COPIES), EXPAND_CHUNK
    some = df.filter(f"{n} <= {b}").selectExpr(*cols(rest), f"explode(array_repeat(0, CAST({n} AS INT))) AS _rep")
    chunks = df.filter(f"{n} > {b}").selectExpr(
        *cols(rest), n, f"explode(sequence(0, CAST(({n} - 1) DIV {b} AS INT))) AS _chunk").hint("rebalance")
    many = chunks.selectExpr(*cols(rest), f"explode(array_repeat(0, CAST(least({b}, {n} - _chunk * {b}) AS INT))) AS _rep")
    return some.union(many).drop("_rep")


def raw_features_unexpanded(silver: DataFrame,
                            daily: Mapping[str, DataFrame] | None = None,
                            slicing: Slicing = SLICING,
                            label: bool = False, running: DataFrame | None = None) -> DataFrame:
    """O27/O73 before the tie fan-out: one row per event, plus ``_copies``.

    ``daily`` may supply the day-level sets (e.g. read back from gold
    tables), ``running`` the events with their running metrics (``running_events``).
    """
    daily = daily if daily is not None else daily_frames(silver)
    base = feature_base(silver)
    events = session_features(running, SESSION_LEVELS, base.columns, label) if running is not None \
        else with_session_features(base, SESSION_LEVELS, slicing, label)
    keyed = day_features(base, daily)
    # One exchange of the (wide) event rows for all three day-level sets: the
    # join on (user, product, day) -- null-safe on the user, so an event of a
    # NULL user still finds its product's features -- is 1:1.
    on = (F.col("e.user_id").eqNullSafe(F.col("k.user_id"))
          & (F.col("e.product_id") == F.col("k.product_id"))
          & (F.col("e.batch_time") == F.col("k.batch_time")))
    joined = events.alias("e").join(keyed.alias("k"), on, "left")
    day_cols = [f"{t}__{m}" for t in DAILY_TABLES for m in METRICS]
    out = [f"e.{q(c)}" if c not in day_cols else f"k.{q(c)}"
           for c in [*EVENT_COLUMNS, *FEATURES, COPIES, *([LABEL] if label else [])]]
    return joined.selectExpr(*out)


def day_features(events: DataFrame, daily: Mapping[str, DataFrame]) -> DataFrame:
    """The three day-level sets per distinct (user, product, day) of ``events``.

    The key table is an aggregate (combined map-side) of three narrow
    columns, so the three N:1 joins move narrow rows; a NULL user matches no
    user-level set, as in a plain join.
    """
    keys = events.select("user_id", "product_id", "batch_time").distinct()
    for table in DAILY_TABLES:
        keys = attach(keys, daily[table], table)
    return keys


def raw_features(silver: DataFrame, daily: Mapping[str, DataFrame] | None = None,
                 ties: str = "multiply", slicing: Slicing = SLICING) -> DataFrame:
    """Every event with its 50 point-in-time features."""
    return expand(raw_features_unexpanded(silver, daily, slicing), ties)


def session_product_outcomes(silver: DataFrame) -> DataFrame:
    """1 if the user bought the product at any time in the session."""
    bought = f"MAX(CASE WHEN event_type = '{PURCHASE}' THEN 1 ELSE 0 END) AS {LABEL}"
    return silver.groupBy(*LABEL_KEYS).agg(F.expr(bought))


def labelled(raw_with_label: DataFrame) -> DataFrame:
    """Keep the events that have a label -- the inner join on the label
    key; NULL users drop out here (Q8)."""
    keep = [*LABEL_KEYS, "batch_time", "event_time", "event_type", *FEATURES]
    extra = [COPIES] if COPIES in raw_with_label.columns else []
    return project(raw_with_label.filter(f"{LABEL} IS NOT NULL"), cols([*keep, LABEL, *extra]))


def training_rows(raw_with_labels: DataFrame) -> DataFrame:
    """Drop purchase events and the per-event columns."""
    rest = [c for c in raw_with_labels.columns if c not in DROPPED_FOR_TRAINING]
    return project(raw_with_labels.filter(f"event_type != '{PURCHASE}'"), cols(rest))


def raw_features_and_labels(silver: DataFrame, ties: str = "multiply",
                            slicing: Slicing = SLICING,
                            daily: Mapping[str, DataFrame] | None = None) -> DataFrame:
    raw = raw_features_unexpanded(silver, daily, slicing, label=True)
    return expand(labelled(raw), ties)


def features_and_labels(silver: DataFrame, ties: str = "multiply",
                        slicing: Slicing = SLICING,
                        daily: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The training table, 50 features + label per (user, session) event."""
    raw = raw_features_unexpanded(silver, daily, slicing, label=True)
    out = training_rows(labelled(raw))
    weight = [COPIES] if ties == "weight" else []
    return project(expand(out, ties), cols(["user_id", "user_session", *FEATURES, LABEL, *weight]))
