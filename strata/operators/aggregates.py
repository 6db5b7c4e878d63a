"""Aggregates used by checks and reports (all partial + final hash aggregation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.cleaning import normalize_code, to_int64


def _names(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


# AG-04 / DQ-07
def duplicate_keys(df: DataFrame, keys, count_col: str = "cnt") -> DataFrame:
    """Key combinations occurring more than once, with their count."""
    ks = _names(keys)
    return df.groupBy(*ks).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


# AG-05
def multi_valued(df: DataFrame, keys, values, count_col: str = "combos") -> DataFrame:
    """Keys with more than one distinct combination of ``values`` (NULL-bearing
    combinations count, as with a struct)."""
    ks, vs = _names(keys), _names(values)
    v = F.struct(*[F.col(c) for c in vs]) if len(vs) > 1 else F.col(vs[0])
    return df.groupBy(*ks).agg(F.count_distinct(v).alias(count_col)).where(F.col(count_col) > 1)


# AG-06
def nunique_vs_rows(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_distinct(key).alias("distinct_keys"), F.count(F.lit(1)).alias("row_count"))


# AG-07
def duplicate_stats(df: DataFrame, col: str) -> DataFrame:
    """Number of duplicated values and number of rows holding them (non-NULL values)."""
    d = duplicate_keys(df.where(F.col(col).isNotNull()), col, "_n")
    return d.agg(F.count(F.lit(1)).alias("duplicated_values"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_with_duplicates"))


# AG-08
def max_id(df: DataFrame, col: str) -> DataFrame:
    """Largest numeric id, malformed ids ignored, 0 when there is none."""
    return df.agg(F.coalesce(F.max(to_int64(col)), F.lit(0).cast("bigint")).alias("max_id"))


# AG-09
def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def canonical_row(df: DataFrame) -> Column:
    """A row as one text, columns in name order: integers, booleans, dates and decimals in plain digits, timestamps as
    microseconds, nested values as JSON, NULL apart from every value."""
    def text(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))
    return F.concat_ws("\x1f", *[text(f) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def content_metrics(df: DataFrame) -> list[Column]:
    """Row count and content hash as aggregates: the sum of 60 bits of every row's md5 does not depend on the order of rows
    and tells repeated rows.  Usable in ``agg`` and, while a table is written, in ``observe``."""
    bits = F.conv(F.substring(F.md5(canonical_row(df)), 1, 15), 16, 10).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(bits).cast("decimal(38,0)"), F.lit(0)).cast("string").alias("content_hash")]


# AG-10
def distinct_codes(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    return df.select(normalize_code(col).alias(out)).where(F.col(out).isNotNull()).distinct()


# AG-03
def min_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Earliest non-NULL ``value`` per non-NULL ``key``."""
    return (df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
              .groupBy(key).agg(F.min(value).alias(out)))
