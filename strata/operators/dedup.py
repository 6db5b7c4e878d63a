"""Row-selection operators over keys: latest version, keep-first, duplicates, top-n.

Scale notes
-----------
* ``deduplicate`` / ``top_n`` use ``row_number() <= n``; Spark plans this as a
  partial ``WindowGroupLimit`` before the shuffle, so a hot key ships at most
  ``n`` rows per map partition, never its whole group.
* ``first_per_key`` returns the first row per key from one aggregate
  (``min`` over a struct of order and row), partial before the shuffle and
  with no join back, when the removed rows themselves are not needed.
* ``keep_first``, ``mark_duplicates`` and ``count_over`` avoid unbounded window
  partitions altogether: they aggregate per key (map-side partial aggregation)
  and join the small per-key result back.  Rows without a key are spread over hash
  buckets.  The row counts of that aggregate tell the hot keys: one above ``hot_rows`` is dealt over count / hot_rows
  tasks, with as many copies of its per-key row, so the largest task is bounded without AQE's skew handling too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import HOT_ROWS, NULL_KEY_BUCKETS, hot_keys, spread


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _names(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _join_back(df: DataFrame, per_key: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """``df`` joined null-safe with one row per key and its row count ``_rows`` (dropped).

    The rows without any key carry a hash bucket as a second join key, and the one per-key row they share is
    repeated for every bucket; keys with more than ``hot_rows`` rows are dealt in the same way over as
    many buckets as their count needs."""
    no_key = F.lit(True)
    for k in keys:
        no_key = no_key & F.col(f"`{k}`").isNull()
    left, right = spread(df, per_key, hot_keys(per_key.where(~no_key), keys, "_rows", hot_rows), keys, keys)
    row = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id()), F.lit(NULL_KEY_BUCKETS))
    left = left.withColumn("_ls", F.coalesce(F.when(no_key, row).otherwise(F.col("_ls")), F.lit(0)).cast("bigint"))
    buckets = F.sequence(F.lit(0).cast("bigint"), F.lit(NULL_KEY_BUCKETS - 1).cast("bigint"))
    right = (right.withColumn("_rs", F.explode(F.when(no_key, buckets).otherwise(F.array("_rs"))))
             .drop("_rows").withColumnsRenamed({k: f"_pk_{k}" for k in keys}))
    cond = left["_ls"] == right["_rs"]
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_pk_{k}"])
    return left.join(right, cond).drop("_ls", "_rs", *[f"_pk_{k}" for k in keys])


# WN-01
def deduplicate(df: DataFrame, keys, order: Sequence, tie_break: Sequence = ()) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (+ optional tie-break)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(list(order) + list(tie_break)))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


# WN-02 / SO-03
def top_n(df: DataFrame, keys, order: Sequence, n: int = 3, rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..n per key (row_number semantics), rank in ``rank_col``."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


# WN-03
def count_over(df: DataFrame, keys, value: str, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Append ``count(value) over (partition by keys)`` as ``name``.

    Computed as a per-key aggregate joined back (null-safe on the keys), so a hot
    key never has to fit one window partition.
    """
    ks = _names(keys)
    return _join_back(df, df.groupBy(*ks).agg(F.count(value).alias(name), F.count(F.lit(1)).alias("_rows")), ks, hot_rows)


# WN-05
def mark_duplicates(df: DataFrame, keys, flag: str = "is_duplicate", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Flag every row whose key occurs more than once (pandas ``duplicated(keep=False)``)."""
    ks = _names(keys)
    n = F.count(F.lit(1))
    j = _join_back(df, df.groupBy(*ks).agg((n > 1).alias("_many"), n.alias("_rows")), ks, hot_rows)
    return j.withColumn(flag, F.col("_many")).drop("_many")


# WN-04
def keep_first(df: DataFrame, keys, order, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Split into (first row per key under ``order``, the removed rows).

    ``order`` is a column or list of columns (an input-position column, or enough
    columns to be unique within a key).  Ties go to the smallest row, and of identical
    rows one stays, so exactly one row per key is kept whatever the order.  The winner per
    key is a ``min`` over the order struct — a partial aggregate, so a hot key is
    reduced map-side — and joined back, hot keys dealt by their counts.
    """
    ks = _names(keys)
    ords = _cols(order)
    cols = [F.col(f"`{c}`") for c in df.columns]
    tagged = df.withColumn("_ord", F.struct(F.struct(*ords).alias("o"), F.struct(*cols).alias("r")))
    first = tagged.groupBy(*ks).agg(F.min("_ord").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    j = _join_back(tagged, first, ks, hot_rows).withColumn("_keep", F.col("_ord") == F.col("_first")).drop("_first")
    # the winners of a key are identical rows: one is kept, its copies are removed rows
    won = j.where("_keep").groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    copies = won.withColumn("_i", F.explode(F.expr("sequence(1, _n)"))).where("_i > 1").drop("_n", "_i")
    return won.drop("_n"), j.where(~F.col("_keep")).drop("_keep", "_ord").unionByName(copies)


# WN-04 (kept rows only)
def first_per_key(df: DataFrame, keys, order, dup_col: str | None = None, sums: Sequence[str] = ()) -> DataFrame:
    """First row per key under ``order`` (unique within a key) and, in ``dup_col``,
    how many other rows the key had.  The columns ``sums`` are added up over the key's rows.

    One grouped aggregate over ``min(struct(order and row))``: map-side partial
    aggregation leaves one row per key and map partition, so a key holding a
    third of the table never reaches one task whole, and the input is scanned
    once (no join back).  NULL keys form one group, as with ``keep_first``.
    """
    ks = _names(keys)
    ords = [order] if isinstance(order, (str, Column)) else list(order)
    # a column of the order is carried once, in the order; equal orders have it equal, so the smallest row is the same
    place = {o: i for i, o in reversed(list(enumerate(ords))) if isinstance(o, str) and o in df.columns}
    rest = [c for c in df.columns if c not in ks and c not in sums and c not in place]
    # one flat struct, the order before the rest: rows compare as they would by (order, rest), and are copied as one piece
    packed = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(ords))],
                      *[F.col(f"`{c}`").alias(f"r{i}") for i, c in enumerate(rest)])
    aggs = [F.min(packed).alias("_m")]
    if dup_col:
        aggs.append((F.count(F.lit(1)) - 1).alias(dup_col))
    g = df.groupBy(*ks).agg(*aggs, *[F.sum(f"`{c}`").alias(c) for c in sums])
    out = [F.col(f"`{c}`") if c in ks or c in sums else
           F.col("_m").getField(f"o{place[c]}" if c in place else f"r{rest.index(c)}").alias(c) for c in df.columns]
    return g.select(*out, *([dup_col] if dup_col else []))
