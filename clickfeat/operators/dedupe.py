"""Deterministic dedupe on a column subset.

``dropDuplicates(subset)`` keeps an arbitrary row. Here the survivor is the
smallest row by ``order`` and then by the remaining columns, computed as a
``min`` over a struct. Being an aggregate, it is combined map-side before the
shuffle: a group holding a large share of all rows (many copies of one event)
is reduced to one row per map task, never gathered into one task. NULL keys
form one group, as in ``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW = "_survivor"


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [*order, *rest]
    if not ranked:
        return df.select(*keys).distinct()
    survivor = F.min(F.struct(*[F.col(c) for c in ranked])).alias(_ROW)
    return (
        df.groupBy(*keys)
        .agg(survivor)
        .select(*[F.col(c) if c in keys else F.col(f"{_ROW}.{c}").alias(c) for c in df.columns])
    )
