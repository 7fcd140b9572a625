"""Gold metric tables: point-in-time running metrics and day-level cumulative ones.

Running metrics (per session, per session x product) give at every event the
counts of events, views, carts and purchases so far in the key, events tied
on ``event_time`` included, plus six ratios. Daily metrics (per user, per
product, per user x product) give the same cumulative through day d, stamped
``batch_time = d + 1`` so they are only visible the day after.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.ratios import COUNTS, METRICS, TYPED_COUNTS, with_ratios
from clickfeat.operators.running import SLICING, Slicing, with_running

TIME = "event_time"
DAY = "batch_time"

# The five metric tables and their join keys.
SESSION_KEYS = ("user_id", "user_session")
PRODUCT_SESSION_KEYS = ("user_id", "user_session", "product_id")
METRIC_TABLES = {
    "session_metrics": ("user_id", "user_session", "event_time"),
    "product_session_metrics": ("user_id", "user_session", "product_id", "event_time"),
    "user_metrics": ("user_id", "batch_time"),
    "product_metrics": ("product_id", "batch_time"),
    "user_product_metrics": ("user_id", "product_id", "batch_time"),
}


def count_aggs(type_col: str = "event_type") -> list:
    """events = COUNT(*), and a conditional sum per counted type."""
    typed = [F.expr(f"SUM(CASE WHEN {type_col} = '{value}' THEN 1 ELSE 0 END) AS {name}")
             for name, value in TYPED_COUNTS]
    return [F.expr("COUNT(1) AS events"), *typed]


def running_table(events: DataFrame, name: str, keys: Sequence[str],
                  slicing: Slicing = SLICING) -> DataFrame:
    """Running metrics per ``keys`` as the reference table: one row per event
    (keys, event_time, the ten METRICS). NULL keys form their own group."""
    r = with_running(events.select(*keys, TIME, "event_type"), {name: keys}, slicing=slicing)
    return level_table(r, name, keys)


def level_table(running: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One level's metric table as a projection of events that have its metrics."""
    return running.selectExpr(*keys, TIME, *[f"{name}__{m} AS {m}" for m in METRICS])


def session_metrics(silver: DataFrame, slicing: Slicing = SLICING) -> DataFrame:
    """Running metrics per (user_id, user_session) at every event."""
    return running_table(silver, "session_metrics", SESSION_KEYS, slicing)


def product_session_metrics(silver: DataFrame, slicing: Slicing = SLICING) -> DataFrame:
    """Running metrics per (user_id, user_session, product_id) at every event."""
    return running_table(silver, "product_session_metrics", PRODUCT_SESSION_KEYS, slicing)


def next_day(time_col: str = TIME) -> str:
    """The day after the event, as a midnight timestamp (session time zone)."""
    return f"date_trunc('day', date_add(CAST({time_col} AS DATE), 1))"


def daily_counts(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (key, next day) counts: what a key did on the day before batch_time."""
    stamped = silver.selectExpr(*keys, "event_type", f"{next_day()} AS {DAY}")
    return stamped.groupBy(*keys, DAY).agg(*count_aggs())


def daily_metrics(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cumulative day-level metrics per key, one row per active day.

    The window runs over the daily aggregate, so a partition holds one row
    per active day of the key -- bounded by the data's span in days however
    many events the key has; the aggregate before it is combined map-side.
    """
    return cumulative(daily_counts(silver, keys), keys)


def rollup_daily(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Day counts of a coarser key, summed from a finer key's day counts."""
    return daily.groupBy(*keys, DAY).agg(*[F.expr(f"SUM({c}) AS {c}") for c in COUNTS])


def cumulative(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running totals of day counts per key, plus the six ratios."""
    w = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {DAY})"
    cum = daily.selectExpr(*keys, DAY, *[f"SUM({c}) {w} AS {c}" for c in COUNTS])
    return with_ratios(cum)


def user_metrics(silver: DataFrame) -> DataFrame:
    return daily_metrics(silver, ["user_id"])


def product_metrics(silver: DataFrame) -> DataFrame:
    return daily_metrics(silver, ["product_id"])


def user_product_metrics(silver: DataFrame) -> DataFrame:
    return daily_metrics(silver, ["user_id", "product_id"])
