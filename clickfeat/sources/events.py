"""Event sources: the native clickstream schema and the driver-table adapter.

The native input is a headed CSV file per drop with nine string columns.
The test tables ship a generic ``events`` table instead; ``from_driver_events``
maps it onto the native schema (event_id is carried as the dedupe tiebreak).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The native column names, in file order.
NATIVE_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)

# A CSV loader presents every native column as a string.
NATIVE_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in NATIVE_COLUMNS])

TIEBREAK = "event_id"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _hour_ceiling(cutoff: dt.datetime) -> dt.datetime:
    floor = cutoff.replace(minute=0, second=0, microsecond=0)
    return floor if floor == cutoff else floor + dt.timedelta(hours=1)


def from_driver_events(spark: SparkSession, sf_dir: str,
                       before: dt.datetime | None = None) -> DataFrame:
    """Map the driver ``events`` table onto the native clickstream schema.

    ``before`` optionally bounds ``event_time`` (exclusive). Because the
    mapped event_time is ``ts`` truncated to the hour, ``hour(ts) < c`` is
    the same as ``ts < ceil_hour(c)``, a predicate on the raw column that
    reaches the parquet scan as a pushed filter.
    """
    raw = spark.read.parquet(table_path(sf_dir, "events"))
    if before is not None:
        raw = raw.filter(F.col("ts") < F.lit(_hour_ceiling(before)).cast("timestamp_ntz"))
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("int")
    return raw.select(
        F.col("event_id").alias(TIEBREAK),
        F.date_trunc("hour", ts).alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
        .otherwise(F.col("event_type")).alias("event_type"),
        (k % 10).cast("string").alias("product_id"),
        (k % 5).cast("string").alias("category_id"),
        F.lit(None).cast("string").alias("category_code"),
        F.lit(None).cast("string").alias("brand"),
        F.col("value").cast("float").alias("price"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format(F.date_trunc("week", ts), "yyyyMMdd")).alias("user_session"),
    )


def as_csv_strings(df: DataFrame) -> DataFrame:
    """The native columns as a CSV loader would present them (all strings)."""
    keep = [c for c in df.columns if c not in NATIVE_COLUMNS]
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in NATIVE_COLUMNS])


def read_path(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch scan of a parquet folder (O5). With ``schema`` no file footer is read
    for it; columns that older files lack are NULL."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
