"""Newest / first N rows per key.

``row_number() <= n`` lets Catalyst keep only n rows per key in every map task
before the shuffle, so a hot key sends n rows per task and no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _names(columns: str | list[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def first_per_key(df: DataFrame, keys: str | list[str], order: str | list[str], n: int = 1) -> DataFrame:
    """The first n rows per key, ascending."""
    window = Window.partitionBy(*_names(keys)).orderBy(*[F.asc(c) for c in _names(order)])
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def latest_per_key(df: DataFrame, keys: str | list[str], order: str | list[str], n: int = 1) -> DataFrame:
    """The newest n rows per key; later names in ``order`` break ties."""
    window = Window.partitionBy(*_names(keys)).orderBy(*[F.desc(c) for c in _names(order)])
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def of_codes(df: DataFrame, codes: str | list[str] | None, column: str = "stock_code") -> DataFrame:
    """Rows of one code, of a set of codes, or all (None).  Pushed to the scan."""
    if codes is None:
        return df
    return df.where(F.col(column).isin(_names(codes)))
