"""SQL expression strings for wide projections.

A projection over tens of columns is stated as ``selectExpr`` strings: the
JVM parses the list in one pass instead of the driver building one Column
object (several gateway round trips) per column. The plans are the same.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def q(name: str) -> str:
    """A quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def as_(expr: str, name: str) -> str:
    return f"{expr} AS {q(name)}"


def cols(names: Iterable[str]) -> list[str]:
    return [q(n) for n in names]


def null_of(dtype: T.DataType) -> str:
    return f"CAST(NULL AS {dtype.simpleString()})"


def zero_of(dtype: T.DataType) -> str:
    return "''" if isinstance(dtype, T.StringType) else f"CAST(0 AS {dtype.simpleString()})"


def ratio(numerator: str, denominator: str) -> str:
    """numerator / denominator as double, NULL when the denominator is 0."""
    return f"try_divide({q(numerator)}, {q(denominator)})"


def project(df: DataFrame, exprs: Iterable[str]) -> DataFrame:
    return df.selectExpr(*exprs)
