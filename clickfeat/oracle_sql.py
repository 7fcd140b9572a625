"""DuckDB statements that state each query's expected result independently.

They follow the reference semantics literally (plain windows with the default
RANGE frame, per-event metric tables, USING joins with their tie fan-out),
so they check the Spark plans, which compute the same numbers differently.
DuckDB traps handled here: ``x/0`` is inf/nan (use NULLIF), SUM and COUNT_IF
give HUGEINT (cast to BIGINT).
"""

from __future__ import annotations

import random

# Metric and feature names (same as clickfeat.functions.ratios).
COUNTS = ("events", "views", "carts", "purchases")
RATIOS = (
    ("view_to_events", "views", "events"),
    ("carts_to_events", "carts", "events"),
    ("purchases_to_events", "purchases", "events"),
    ("carts_to_views", "carts", "views"),
    ("purchases_to_views", "purchases", "views"),
    ("purchases_to_carts", "purchases", "carts"),
)
METRICS = COUNTS + tuple(r[0] for r in RATIOS)
METRIC_TABLES = {
    "session_metrics": ("user_id", "user_session", "event_time"),
    "product_session_metrics": ("user_id", "user_session", "product_id", "event_time"),
    "user_metrics": ("user_id", "batch_time"),
    "product_metrics": ("product_id", "batch_time"),
    "user_product_metrics": ("user_id", "product_id", "batch_time"),
}
FEATURES = tuple(f"{t}__{m}" for t in METRIC_TABLES for m in METRICS)


def _ratios_sql() -> str:
    return ",\n       ".join(f"CAST({n} AS DOUBLE) / NULLIF({d}, 0) AS {name}" for name, n, d in RATIOS)


MAPPED = """mapped AS (
  SELECT event_id,
         date_trunc('hour', ts) AS event_time,
         CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR) AS product_id,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS category_id,
         CAST(NULL AS VARCHAR) AS category_code,
         CAST(NULL AS VARCHAR) AS brand,
         CAST(value AS FLOAT) AS price,
         CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(date_trunc('week', ts), '%Y%m%d') AS user_session
  FROM events
)"""

NATIVE = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"

SILVER = f"""silver AS (
  SELECT {NATIVE} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_time, event_type, category_id, user_session ORDER BY event_id) AS rn
    FROM mapped
    WHERE event_time IS NOT NULL AND event_type IS NOT NULL
      AND product_id IS NOT NULL AND user_session IS NOT NULL
  ) WHERE rn = 1
)"""


def running_cte(name: str, keys: tuple[str, ...]) -> str:
    part = ", ".join(keys)
    w = f"OVER (PARTITION BY {part} ORDER BY event_time)"
    return f"""{name} AS (
  SELECT {part}, event_time, {", ".join(COUNTS)},
       {_ratios_sql()}
  FROM (
    SELECT {part}, event_time,
           COUNT(*) {w} AS events,
           CAST(COUNT_IF(event_type = 'view') {w} AS BIGINT) AS views,
           CAST(COUNT_IF(event_type = 'cart') {w} AS BIGINT) AS carts,
           CAST(COUNT_IF(event_type = 'purchase') {w} AS BIGINT) AS purchases
    FROM silver
  )
)"""


def daily_counts_cte(name: str, keys: tuple[str, ...]) -> str:
    part = ", ".join(keys)
    return f"""{name} AS (
  SELECT {part}, batch_time,
         COUNT(*) AS events,
         CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
         CAST(SUM(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS BIGINT) AS carts,
         CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases
  FROM (SELECT *, CAST(CAST(event_time AS DATE) + 1 AS TIMESTAMP) AS batch_time FROM silver)
  GROUP BY {part}, batch_time
)"""


def daily_cte(name: str, keys: tuple[str, ...]) -> str:
    part = ", ".join(keys)
    w = f"OVER (PARTITION BY {part} ORDER BY batch_time)"
    sums = ",\n           ".join(f"CAST(SUM({c}) {w} AS BIGINT) AS {c}" for c in COUNTS)
    return f"""{daily_counts_cte(name + '_daily', keys)},
{name} AS (
  SELECT {part}, batch_time, {", ".join(COUNTS)},
       {_ratios_sql()}
  FROM (
    SELECT {part}, batch_time,
           {sums}
    FROM {name}_daily
  )
)"""


METRIC_CTES = {
    "session_metrics": running_cte("session_metrics", ("user_id", "user_session")),
    "product_session_metrics": running_cte(
        "product_session_metrics", ("user_id", "user_session", "product_id")),
    "user_metrics": daily_cte("user_metrics", ("user_id",)),
    "product_metrics": daily_cte("product_metrics", ("product_id",)),
    "user_product_metrics": daily_cte("user_product_metrics", ("user_id", "product_id")),
}


def prefixed_cte(table: str) -> str:
    keys = METRIC_TABLES[table]
    cols = ", ".join(f"{m} AS {table}__{m}" for m in METRICS)
    return f"{table}_p AS (SELECT {', '.join(keys)}, {cols} FROM {table})"


BASE = """base AS (
  SELECT user_id, user_session, product_id, event_time, event_type,
         date_trunc('day', event_time) AS batch_time
  FROM silver
)"""

OUTCOMES = """outcomes AS (
  SELECT user_id, user_session, product_id,
         CAST(MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS purchased
  FROM silver GROUP BY user_id, user_session, product_id
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _all_metric_ctes(collapse: bool = False) -> list[str]:
    out = []
    for t in METRIC_TABLES:
        out.append(METRIC_CTES[t])
        if collapse and t in ("session_metrics", "product_session_metrics"):
            out.append(f"{t}_d AS (SELECT DISTINCT * FROM {t})")
            out.append(prefixed_cte(t).replace(f"FROM {t})", f"FROM {t}_d)"))
        else:
            out.append(prefixed_cte(t))
    return out


def raw_features_cte(collapse: bool = False) -> list[str]:
    joins = "\n  ".join(
        f"LEFT JOIN {t}_p USING ({', '.join(k)})" for t, k in METRIC_TABLES.items())
    feats = ", ".join(FEATURES)
    return [
        MAPPED, SILVER, *_all_metric_ctes(collapse), BASE,
        f"""raw_features AS (
  SELECT user_id, product_id, batch_time, user_session, event_time, event_type, {feats}
  FROM base
  {joins}
)""",
    ]


FEATURES_AND_LABELS_CTES = [
    *raw_features_cte(),
    OUTCOMES,
    f"""raw_features_and_labels AS (
  SELECT user_id, user_session, product_id, batch_time, event_time, event_type,
         {", ".join(FEATURES)}, purchased
  FROM raw_features JOIN outcomes USING (user_id, user_session, product_id)
)""",
    f"""features_and_labels AS (
  SELECT user_id, user_session, {", ".join(FEATURES)}, purchased
  FROM raw_features_and_labels WHERE event_type != 'purchase'
)""",
]

# Session split: the same md5 bucket in both engines.
SPLIT_BUCKET = ("CAST(('0x' || substr(md5(user_id || '|' || user_session), 1, 8)) AS BIGINT) % 1000")
SESSIONS = f"""sessions AS (
  SELECT user_id, user_session, {SPLIT_BUCKET} AS bucket
  FROM (SELECT DISTINCT user_id, user_session FROM features_and_labels)
)"""
SPLIT_RANGES = {
    "train": (0, 800),
    "test": (800, 900),
    "validate": (900, 1000),
    "train_test": (0, 900),
}


def split_sql(part: str) -> str:
    lo, hi = SPLIT_RANGES[part]
    return with_(*FEATURES_AND_LABELS_CTES, SESSIONS) + f"""SELECT {", ".join(FEATURES)}, purchased
FROM sessions JOIN features_and_labels USING (user_id, user_session)
WHERE bucket >= {lo} AND bucket < {hi}"""


# Deterministic score used by the evaluation queries: the running cart
# share of the product in the session so far (NULL -> 0).
SCORE_SQL = "COALESCE(product_session_metrics__carts_to_events, 0.0)"


def search_trials(seed: int, trials: int) -> list[tuple[int, float, float]]:
    """The seeded search's draws: depth (whole, 1 to 20), rate (0.01 to 0.4), weight (1 to 100)."""
    rng = random.Random(seed)
    return [(round(rng.uniform(1, 20)), rng.uniform(0.01, 0.4), rng.uniform(1, 100)) for _ in range(trials)]


def formula_sql(trials: list[tuple[int, float, float]], splits: dict[str, str]) -> str:
    """``measured``: metrics of the formula score for every trial and split.

    The score mixes two cart shares by the trial's rate and is cut to steps of
    1 / (depth + 1); the class is 1 where score * weight >= 1 - score.
    """
    number = lambda x: f"CAST('{x!r}' AS DOUBLE)"
    rows = ", ".join(f"({k}, {d}, {number(r)}, {number(w)})" for k, (d, r, w) in enumerate(trials))
    cases = " ".join(f"SELECT '{name}' AS split, {SPLIT_RANGES[part][0]} AS lo, {SPLIT_RANGES[part][1]} AS hi UNION ALL"
                     for name, part in splits.items()).removesuffix(" UNION ALL")
    return with_(*FEATURES_AND_LABELS_CTES, SESSIONS) + f""",
trials(trial, max_depth, learning_rate, scale_pos_weight) AS (VALUES {rows}),
splits AS ({cases}),
mixed AS (
  SELECT trial, split, scale_pos_weight, purchased AS label,
         floor((learning_rate * COALESCE(product_session_metrics__carts_to_events, CAST(0 AS DOUBLE))
                + (CAST(1 AS DOUBLE) - learning_rate) * COALESCE(session_metrics__carts_to_events, CAST(0 AS DOUBLE)))
               * (max_depth + 1)) / (max_depth + 1) AS score
  FROM sessions JOIN features_and_labels USING (user_id, user_session) JOIN splits ON bucket >= lo AND bucket < hi, trials),
counts AS (
  SELECT trial, split, CAST(COUNT_IF(label = 1 AND hit) AS DOUBLE) AS tp, CAST(COUNT_IF(label = 0 AND hit) AS DOUBLE) AS fp,
         CAST(COUNT_IF(label = 0 AND NOT hit) AS DOUBLE) AS tn, CAST(COUNT_IF(label = 1 AND NOT hit) AS DOUBLE) AS fn
  FROM (SELECT *, score * scale_pos_weight >= CAST(1 AS DOUBLE) - score AS hit FROM mixed) GROUP BY trial, split),
per_score AS (
  SELECT trial, split, score, CAST(SUM(label) AS DOUBLE) AS pos, CAST(COUNT(*) AS DOUBLE) AS n FROM mixed GROUP BY trial, split, score),
cum AS (
  SELECT *, SUM(pos) OVER (PARTITION BY trial, split ORDER BY score DESC) AS tp,
         SUM(n) OVER (PARTITION BY trial, split ORDER BY score DESC) AS k
  FROM per_score),
ranked AS (
  SELECT trial, split, round(COALESCE(SUM(pos * tp / k) / NULLIF(SUM(pos), 0), 0.0), 9) AS average_precision FROM cum GROUP BY trial, split),
measured AS (
  SELECT t.trial, max_depth, learning_rate, scale_pos_weight, split, average_precision,
         round((COALESCE(tp / NULLIF(tp + fn, 0), 0) + COALESCE(tn / NULLIF(tn + fp, 0), 0))
               / NULLIF(CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END + CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END, 0), 9) AS balanced_accuracy,
         round(COALESCE((tp * tn - fp * fn) / NULLIF(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0), 9) AS mcc
  FROM trials t JOIN ranked USING (trial) JOIN counts USING (trial, split))
"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_events"] = with_(MAPPED) + (
        f"SELECT {NATIVE} FROM mapped WHERE event_time < TIMESTAMP '2024-01-22 00:00:00'")
    q["silver_cast"] = with_(MAPPED) + f"SELECT {NATIVE} FROM mapped"
    q["silver_dropna"] = with_(MAPPED) + (
        f"SELECT {NATIVE} FROM mapped WHERE event_time IS NOT NULL AND event_type IS NOT NULL"
        " AND product_id IS NOT NULL AND user_session IS NOT NULL")
    q["silver_events"] = with_(MAPPED, SILVER) + "SELECT * FROM silver"
    for t in ("session_metrics", "product_session_metrics"):
        q[t] = with_(MAPPED, SILVER, METRIC_CTES[t]) + f"SELECT * FROM {t}"
    q["user_daily_counts"] = with_(MAPPED, SILVER, daily_counts_cte("d", ("user_id",))) + (
        "SELECT * FROM d")
    for t in ("user_metrics", "product_metrics", "user_product_metrics"):
        q[t] = with_(MAPPED, SILVER, METRIC_CTES[t]) + f"SELECT * FROM {t}"
    q["metrics_prefixed"] = with_(
        MAPPED, SILVER, METRIC_CTES["user_product_metrics"], prefixed_cte("user_product_metrics")
    ) + "SELECT * FROM user_product_metrics_p"
    for t, short in (("session_metrics", "session"),
                     ("product_session_metrics", "product_session"),
                     ("user_metrics", "user"), ("product_metrics", "product"),
                     ("user_product_metrics", "user_product")):
        q[f"join_{short}"] = with_(MAPPED, SILVER, METRIC_CTES[t], prefixed_cte(t), BASE) + (
            f"SELECT * FROM base LEFT JOIN {t}_p USING ({', '.join(METRIC_TABLES[t])})")
    q["raw_features"] = with_(*raw_features_cte()) + "SELECT * FROM raw_features"
    q["raw_features_collapsed"] = with_(*raw_features_cte(collapse=True)) + (
        "SELECT * FROM raw_features")
    q["session_product_outcomes"] = with_(MAPPED, SILVER, OUTCOMES) + "SELECT * FROM outcomes"
    q["raw_features_and_labels"] = with_(*FEATURES_AND_LABELS_CTES) + (
        "SELECT * FROM raw_features_and_labels")
    q["features_and_labels"] = with_(*FEATURES_AND_LABELS_CTES) + (
        "SELECT * FROM features_and_labels")
    q["sessions_distinct"] = with_(*FEATURES_AND_LABELS_CTES) + (
        "SELECT DISTINCT user_id, user_session FROM features_and_labels")
    q["session_split"] = with_(*FEATURES_AND_LABELS_CTES, SESSIONS) + (
        "SELECT user_id, user_session, CASE WHEN bucket < 800 THEN 'train' "
        "WHEN bucket < 900 THEN 'test' ELSE 'validate' END AS split FROM sessions WHERE bucket IS NOT NULL")
    for part in SPLIT_RANGES:
        q[f"split_{part}"] = split_sql(part)
    scored = with_(*FEATURES_AND_LABELS_CTES) + (
        f", scored AS (SELECT purchased AS label, {SCORE_SQL} AS score FROM features_and_labels)\n")
    q["class_metrics"] = scored + """, cm AS (
  SELECT CAST(COUNT_IF(label = 1 AND score >= 0.5) AS DOUBLE) AS tp,
         CAST(COUNT_IF(label = 0 AND score >= 0.5) AS DOUBLE) AS fp,
         CAST(COUNT_IF(label = 0 AND score < 0.5) AS DOUBLE) AS tn,
         CAST(COUNT_IF(label = 1 AND score < 0.5) AS DOUBLE) AS fn
  FROM scored)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn,
       CAST(fn AS BIGINT) AS fn,
       round((COALESCE(tp / NULLIF(tp + fn, 0), 0) + COALESCE(tn / NULLIF(tn + fp, 0), 0))
             / NULLIF(CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END + CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END, 0), 6)
         AS balanced_accuracy,
       round(COALESCE((tp * tn - fp * fn) / NULLIF(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0), 6)
         AS mcc
FROM cm"""
    q["average_precision"] = scored + """, per_score AS (
  SELECT score, CAST(SUM(label) AS DOUBLE) AS pos, CAST(COUNT(*) AS DOUBLE) AS n
  FROM scored GROUP BY score),
cum AS (
  SELECT score, pos, n, SUM(pos) OVER (ORDER BY score DESC) AS tp,
         SUM(n) OVER (ORDER BY score DESC) AS k
  FROM per_score)
SELECT round(COALESCE(SUM(pos * tp / k) / NULLIF(SUM(pos), 0), 0.0), 6) AS average_precision,
       CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(n) AS BIGINT) AS scored_rows
FROM cum"""
    for name in ("class_metrics", "average_precision"):
        q[f"{name}_weighted"] = q[name]
    skewed = MAPPED.replace("mapped AS (", "plain AS (", 1) + """,
mapped AS (
  SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN '0' ELSE user_id END AS user_id,
                    CASE WHEN event_id % 3 = 0 THEN '0-hot' ELSE user_session END AS user_session)
  FROM plain)"""
    q["session_metrics_skewed"] = with_(skewed, SILVER, METRIC_CTES["session_metrics"]) + "SELECT * FROM session_metrics"
    q["stream_ingest"] = q["silver_cast"]
    in_a = "coalesce(event_time < TIMESTAMP '2024-01-15 00:00:00', false)"
    q["stream_evolve"] = with_(MAPPED) + (
        f"SELECT {NATIVE}, CASE WHEN NOT {in_a} THEN 'c' || product_id END AS campaign, "
        f"CASE WHEN {in_a} THEN 'drop_a' ELSE 'drop_b' END AS drop, true AS stamped FROM mapped")
    for name, part in (("train_and_score", "test"), ("score_production", "validate")):
        lo, hi = SPLIT_RANGES[part]
        q[name] = with_(*FEATURES_AND_LABELS_CTES, SESSIONS) + (
            "SELECT user_id, user_session, purchased, true AS binary, true AS in_range, true AS agrees, "
            "true AS ranks, true AS separates "
            f"FROM sessions JOIN features_and_labels USING (user_id, user_session) WHERE bucket >= {lo} AND bucket < {hi}")
    trials = search_trials(1, 25)
    q["tuning_trials"] = formula_sql(trials, {"test": "test"}) + (
        "SELECT CAST(trial AS INTEGER) AS trial, max_depth, learning_rate, scale_pos_weight, average_precision, "
        "balanced_accuracy, mcc, -average_precision AS loss, 'query' AS run_id FROM measured")
    q["best_trial"] = formula_sql(trials, {"test": "test"}) + (
        "SELECT max_depth, learning_rate, scale_pos_weight FROM measured ORDER BY average_precision DESC, trial LIMIT 1")
    single = [(3, 0.1, 2.0)]
    q["training_runs"] = formula_sql(single, {"train_test": "train_test", "validate": "validate"}) + (
        "SELECT 'formula' AS run, split, 'query' AS run_id, average_precision, balanced_accuracy, mcc, "
        "true AS average_precision_ok, true AS balanced_accuracy_ok, true AS mcc_ok FROM measured "
        "UNION ALL SELECT 'trained', split, 'query', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
        "true, true, true FROM splits")
    q["model_latest"] = formula_sql(single, {"validate": "validate"}) + (
        "SELECT 'purchase_intent' AS name, CAST(version AS INTEGER) AS version, stage, average_precision, balanced_accuracy, mcc, "
        "'query' AS run_id, version = 2 AS newest "
        "FROM measured, (VALUES (1, 'archived'), (2, 'production')) v(version, stage)")
    q["table_roundtrip"] = q["silver_events"]
    return q
