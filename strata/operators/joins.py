"""Join operators: approval gate, orphans, semi-joins, lookups, audits.

All are equi-joins (some with a residual predicate).  None forces a broadcast:
AQE converts a join to broadcast only from the measured size of the finished
shuffle stage, and splits skewed partitions of the large side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import is_not_true, kyc_txn_filter


# Hash buckets over which rows with a NULL left join key are spread.  See ``left_join``.
NULL_KEY_BUCKETS = 1024


def left_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` on ``left[lkey] = right[rkey]``, NULL keys spread.

    A NULL key never matches, yet hash partitioning sends every NULL-key row
    to one shuffle partition: a nullable foreign key that is NULL in a third of
    the rows would make that one task.  The rows get a second join key — a
    hash bucket of the row where the key is NULL, 0 otherwise, 0 on the right —
    which spreads them over ``NULL_KEY_BUCKETS`` partitions and changes no
    match.
    """
    bucket = F.when(F.col(f"`{lkey}`").isNull(),
                    F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(NULL_KEY_BUCKETS)))
    lb = left.withColumn("_nbl", F.coalesce(bucket, F.lit(0).cast("bigint")))
    # always 0, but not a literal: a literal would be folded into the join
    # condition and drop out of the hash-partitioning keys
    # (non-nullable, so no ``isnotnull`` is inferred on it)
    rb = right.withColumn("_nbr", F.coalesce(F.pmod(F.xxhash64(F.col(f"`{rkey}`")), F.lit(1).cast("bigint")),
                                             F.lit(0).cast("bigint")))
    return lb.join(rb, (lb[lkey] == rb[rkey]) & (lb["_nbl"] == rb["_nbr"]), how).drop("_nbl", "_nbr")


# A key with more rows than this is dealt over several tasks.
HOT_ROWS = 1_000_000
# Hot keys that are told apart.  Of any table at most 1/4096 of its rows can belong to the next one.
MAX_HOT = 4096


def hot_keys(per_key: DataFrame, keys: Sequence[str], rows: str, bound: int = HOT_ROWS) -> DataFrame:
    """(_hk, _copies) of the keys that hold more than ``bound`` rows, from a table with one row per key and its row
    count: the hash of the key, and over how many tasks it is dealt.  At most ``MAX_HOT`` rows of two numbers."""
    hot = (per_key.where(F.col(rows) > bound).select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("_hk"), F.ceil(F.col(rows) / bound).cast("int").alias("_copies"))
           .orderBy(F.desc("_copies"), "_hk").limit(MAX_HOT))
    return hot.groupBy("_hk").agg(F.max("_copies").alias("_copies"))    # keys of one hash share the larger number


def spread(left: DataFrame, right: DataFrame, hot: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a many-to-one join with a second join key: ``_ls`` on the left picks one of the copies that a hot key's
    row gets on the right (``_rs``), 0 for other keys.

    The salt follows the row's values and its partition, so that equal rows are dealt as well, and a lost task
    computes the same again.  The hot keys are joined by broadcast: their number has a fixed bound.
    """
    def copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        h = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
        return df.withColumn("_hk", h).join(F.broadcast(hot), "_hk", "left").withColumn("_copies", F.coalesce("_copies", F.lit(1))).drop("_hk")

    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.spark_partition_id())
    ls = F.when(F.col("_copies") > 1, F.pmod(row, F.col("_copies"))).otherwise(F.lit(0).cast("bigint"))
    rs = F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("_copies") - 1).cast("bigint")))
    return (copies(left, lkeys).withColumn("_ls", F.coalesce(ls, F.lit(0).cast("bigint"))).drop("_copies"),
            copies(right, rkeys).withColumn("_rs", rs).drop("_copies"))


# Salt of the approval-gate join (1 = unsalted).  See ``gate``.
GATE_SALT = 2


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(``key``, rows): one partial aggregate over the key column alone."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


# JN-01
def gate(txn: DataFrame, players: DataFrame, ts_col: str = "timestamp", fk: str = "player_id",
         pk: str = "id", flag: str = "is_kyc_approved", approved: str = "kyc_approved_at",
         salt: int = GATE_SALT, counts: DataFrame | None = None, bound: int = HOT_ROWS) -> DataFrame:
    """Transactions whose player is approved and whose time is at/after approval.

    The join key is salted: each approved player row is repeated ``salt`` times
    and each transaction picks one copy by a hash of its own columns.  A
    sort-merge join then partitions by (player, salt), which does not satisfy
    the player-keyed aggregates and windows that consume the gate, so they get
    their own exchange with partial aggregation / partial top-n before it, and
    AQE may split a skewed join partition without adding a shuffle.  Unsalted,
    a player holding a third of all transactions would pass the join and every
    player-keyed operator after it in one task.  Only the small side grows
    (``salt`` copies of the approved players); when AQE finds it small enough
    it broadcasts it instead.

    ``counts`` (``fk`` and ``rows``, one row per player, see ``key_counts``) makes the salt a measured one: a player with
    more than ``bound`` transactions is dealt over rows / bound tasks, ordinary players are not repeated.
    """
    p = (players.where(F.col(flag) == F.lit(True))
                .select(F.col(pk).alias("_gk"), F.col(flag).alias("_gflag"), F.col(approved).alias("_gat")))
    if counts is not None:
        t, p = spread(txn, p, hot_keys(counts, [fk], "rows", bound), [fk], ["_gk"])
        j = t.join(p, (t[fk] == p["_gk"]) & (t["_ls"] == p["_rs"]), "inner").drop("_ls", "_rs")
    elif salt > 1:
        p = p.withColumn("_gs", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
        # non-nullable (coalesce): a nullable salt makes Catalyst infer an
        # ``isnotnull`` on it and push it below the projection, evaluating the
        # whole row expression twice
        t = txn.withColumn("_ts", F.coalesce(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in txn.columns]),
                                                    F.lit(salt).cast("bigint")), F.lit(0).cast("bigint")))
        j = t.join(p, (t[fk] == p["_gk"]) & (t["_ts"] == p["_gs"]), "inner").drop("_ts", "_gs")
    else:
        j = txn.join(p, txn[fk] == p["_gk"], "inner")
    return j.where(kyc_txn_filter(F.col(ts_col), F.col("_gflag"), F.col("_gat"))).drop("_gk", "_gflag", "_gat")


# JN-10
def gate_violations(txn: DataFrame, players: DataFrame, ts_col: str = "txn_timestamp", fk: str = "player_id",
                    pk: str = "id", flag: str = "is_kyc_approved", approved: str = "kyc_approved_at",
                    unknown_is_violation: bool = False) -> DataFrame:
    """Transactions of a known player who is not approved, or dated before approval.

    With ``unknown_is_violation`` a transaction of an unknown player is a
    violation too (left-join audit).
    """
    p = players.select(F.col(pk).alias("_gk"), F.col(flag).alias("_gflag"), F.col(approved).alias("_gat"))
    j = left_join(txn, p, fk, "_gk") if unknown_is_violation else txn.join(p, txn[fk] == p["_gk"], "inner")
    bad = is_not_true(F.col("_gflag")) | (F.col(ts_col) < F.col("_gat"))
    return j.where(bad).drop("_gk", "_gflag", "_gat")


# JN-04
def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no parent ``pk`` (strict FK check)."""
    keys = parent.select(F.col(pk).alias("_pk"))
    c = child.where(F.col(fk).isNotNull())
    return c.join(keys, c[fk] == keys["_pk"], "left_anti")


# JN-05
def keep_known(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.join(keys, child[fk] == keys["_pk"], "left_semi")


# JN-06
def orphan_count(child: DataFrame, parent: DataFrame, fk: str, pk: str, null_is_orphan: bool = False) -> DataFrame:
    """One-row count of child rows without parent (``null_is_orphan`` like pandas ``isin``)."""
    keys = parent.select(F.col(pk).alias("_pk"))
    c = child.select(fk).where(F.col(fk).isNotNull())
    out = c.join(keys, c[fk] == keys["_pk"], "left_anti")
    if null_is_orphan:                 # counted without joining: a NULL key matches nothing
        out = out.unionAll(child.select(fk).where(F.col(fk).isNull()))
    return out.agg(F.count(F.lit(1)).alias("orphans"))


# JN-07
def lookup(df: DataFrame, parent: DataFrame, fk: str, pk: str, cols: Sequence[str],
           default=None, prefix: str = "") -> DataFrame:
    """Attach ``cols`` of the parent row with ``pk = fk``; missing parent → ``default``.

    ``parent`` must be unique by ``pk`` (a lookup table).
    """
    sel = [F.col(pk).alias("_lk")] + [F.col(c).alias(f"_lv_{c}") for c in cols]
    p = parent.select(*sel)
    j = left_join(df, p, fk, "_lk")
    out = [df[c] for c in df.columns]
    for c in cols:
        v = F.col(f"_lv_{c}")
        out.append((F.coalesce(v, F.lit(default)) if default is not None else v).alias(prefix + c))
    return j.select(*out)


# JN-08
def fill_from(df: DataFrame, col: str, lookup_df: DataFrame, on: str, value: str, lookup_on: str | None = None) -> DataFrame:
    """Fill NULLs of ``col`` from ``lookup_df[value]`` matched on ``df[on] = lookup_df[lookup_on]``."""
    lk = lookup_df.select(F.col(lookup_on or on).alias("_fk"), F.col(value).alias("_fv"))
    j = left_join(df, lk, on, "_fk")
    return j.select(*[F.coalesce(df[c], F.col("_fv")).alias(c) if c == col else df[c] for c in df.columns])


# JN-09
def mismatches(left: DataFrame, right: DataFrame, on: tuple[str, str], predicate, suffix: str = "__r") -> DataFrame:
    """Left join, then keep rows where ``predicate(l, r)`` holds.  Clashing right
    column names get ``suffix``."""
    lk, rk = on
    r = right.select(*[F.col(c).alias(c + suffix if c in left.columns else c) for c in right.columns])
    rk2 = rk + suffix if rk in left.columns else rk
    j = left_join(left, r, lk, rk2)
    return j.where(predicate(left, r))
