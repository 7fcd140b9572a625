"""Hand-made event tables in the native (silver) schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

SILVER_SCHEMA = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.FloatType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_session", T.StringType()),
])

BRONZE_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType())]
    + [T.StructField(f.name, T.StringType()) for f in SILVER_SCHEMA.fields])


def ts(day: int, hour: int = 0, minute: int = 0, second: int = 0, month: int = 1,
       year: int = 2021) -> dt.datetime:
    return dt.datetime(year, month, day, hour, minute, second)


def ev(t, typ, product, user="u1", session="s1", category="c1", price=1.0):
    return (t, typ, product, category, None, None, price, user, session)


def silver_df(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)
