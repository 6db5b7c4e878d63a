"""Projection helpers (PF-07, PF-08, SO-02, ST-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_where(df: DataFrame, col: str, mask: Column, value) -> DataFrame:
    """``col`` := ``value`` where ``mask`` holds (NULL mask = unchanged)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(mask, v).otherwise(F.col(col)))


def ensure_column(df: DataFrame, name: str, dtype: str = "string") -> DataFrame:
    """Add ``name`` as a typed NULL column if it is missing."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def preview(df: DataFrame, order, n: int = 5) -> DataFrame:
    """First ``n`` rows under an explicit order (a top-k: partial sort per partition)."""
    return df.orderBy(*([order] if isinstance(order, (str, Column)) else order)).limit(n)


def append_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """Union by column name; columns missing on either side become NULL."""
    return df.unionByName(new, allowMissingColumns=True)
