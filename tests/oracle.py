"""Spark-vs-DuckDB result comparison in the driver's manner.

Columns are sorted by name; the check is row count, column names and an
order-insensitive hash of the values (floats compared to 9 significant
digits, timestamps as naive UTC).
"""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, pd.Timestamp):
        if v is pd.NaT:
            return "NULL"
        if v.tzinfo is not None:
            v = v.tz_convert("UTC").tz_localize(None)
        return v.isoformat()
    try:
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
        if isinstance(v, float):
            return f"{v:.9g}"
    return str(v)


def frame_digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    rows = sorted("\x1f".join(_norm(v) for v in row) for row in pdf.itertuples(index=False, name=None))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(pdf), cols, h


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    left = spark_df.toPandas()
    right = duck(sf_dir).execute(sql).df()
    ln, lc, lh = frame_digest(left)
    rn, rc, rh = frame_digest(right)
    return {
        "rows_spark": ln, "rows_oracle": rn,
        "cols_match": lc == rc, "hash_match": lh == rh and ln == rn,
        "spark_cols": lc, "oracle_cols": rc,
        "left": left, "right": right,
    }
