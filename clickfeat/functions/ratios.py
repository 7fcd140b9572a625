"""The ten metric columns shared by every gold table, and their ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Column names and ratio definitions of the metric tables.
# The singular "view_to_events" is part of the published schema.
COUNTS = ("events", "views", "carts", "purchases")
RATIOS = (
    ("view_to_events", "views", "events"),
    ("carts_to_events", "carts", "events"),
    ("purchases_to_events", "purchases", "events"),
    ("carts_to_views", "carts", "views"),
    ("purchases_to_views", "purchases", "views"),
    ("purchases_to_carts", "purchases", "carts"),
)
METRICS = COUNTS + tuple(name for name, _, _ in RATIOS)

# Event types counted separately (any other type only adds to "events").
VIEW, CART, PURCHASE = "view", "cart", "purchase"
TYPED_COUNTS = (("views", VIEW), ("carts", CART), ("purchases", PURCHASE))


def with_ratios(df: DataFrame) -> DataFrame:
    """Append the six ratios in one projection (counts must be present)."""
    return df.selectExpr("*", *[f"try_divide({num}, {den}) AS {name}" for name, num, den in RATIOS])
