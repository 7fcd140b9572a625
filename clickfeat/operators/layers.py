"""Bronze and silver layers: cutoff + projection, typed casts, dropna, dedupe."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.operators.dedupe import dedupe
from clickfeat.sources.events import NATIVE_COLUMNS

# Silver column types, required columns and the dedupe key.
SILVER_TYPES = {
    "event_time": T.TimestampType(),
    "event_type": T.StringType(),
    "product_id": T.StringType(),
    "category_id": T.StringType(),
    "category_code": T.StringType(),
    "brand": T.StringType(),
    "price": T.FloatType(),
    "user_id": T.StringType(),
    "user_session": T.StringType(),
}
REQUIRED = ("event_time", "event_type", "product_id", "user_session")
DEDUPE_KEY = ("event_time", "event_type", "category_id", "user_session")


def _as_time(df: DataFrame, name: str) -> Column:
    """A column as timestamp; strings go through try_cast (Q6: bad -> NULL)."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return col
    return col.try_cast(T.TimestampType())


def _present(df: DataFrame, names: Sequence[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")


def bronze(staging: DataFrame, before: dt.datetime | str | None = None,
           carry: Sequence[str] = ()) -> DataFrame:
    """Bronze: events strictly before ``before``, the nine native columns.

    Types stay as ingested. The cutoff compares a typed time, so on a typed
    source it is a plain timestamp predicate that reaches the scan; on string
    input a malformed time fails the comparison and is not kept (Q6).
    ``carry`` names extra columns to keep (e.g. a dedupe tiebreak); one that
    is absent is an error.
    """
    df = staging
    if before is not None:
        cutoff = F.lit(before).cast(T.TimestampType())
        df = df.filter(_as_time(df, "event_time") < cutoff)
    _present(df, carry)
    return df.select(*NATIVE_COLUMNS, *carry)


def silver_cast(bronze_df: DataFrame) -> DataFrame:
    """Typed projection of the nine columns; unparsable values become NULL."""
    cols = []
    for c in bronze_df.columns:
        target = SILVER_TYPES.get(c)
        if target is None:
            cols.append(F.col(c))
        elif bronze_df.schema[c].dataType == target:
            cols.append(F.col(c))
        else:
            cols.append(F.col(c).try_cast(target).alias(c))
    return bronze_df.select(*cols)


def silver_dropna(df: DataFrame) -> DataFrame:
    """Drop rows missing any required column."""
    return df.dropna(how="any", subset=list(REQUIRED))


def silver(bronze_df: DataFrame, tiebreak: Sequence[str] = ("event_id",)) -> DataFrame:
    """Silver: cast, drop incomplete rows, keep one row per dedupe key.

    The survivor of a dedupe group is the row with the smallest ``tiebreak``
    (then the smallest remaining columns), so reruns agree (Q7 made
    deterministic). Tiebreak columns are dropped from the result.
    """
    _present(bronze_df, tiebreak)
    typed = silver_dropna(silver_cast(bronze_df))
    return dedupe(typed, DEDUPE_KEY, list(tiebreak)).select(*NATIVE_COLUMNS)
