"""Type-2 history snapshot (timestamp strategy).

History columns added to the source columns:
  dbt_scd_id      md5 of "<key>|<updated_at>" (empty string for NULL parts)
  dbt_updated_at  source updated_at of the version
  dbt_valid_from  start of validity (= updated_at)
  dbt_valid_to    end of validity, NULL while the version is current

Merge rules for a new ``current`` (unique by key):
  open version whose key has a later updated_at  → closed at that updated_at
  new key, or later version of an open key        → new open version
  anything else                                   → unchanged
  keys absent from ``current``                    → stay open
  rows without key                                → a version per distinct row, never closed

``snapshot_delta`` joins ``current`` with the open versions (both unique per key; rows without key meet by a
hash of their values, so there is no hot key) and gives only what a run adds: new versions and closings.  A stored
history (``sources.history``) appends it.  ``snapshot_merge`` gives the whole history after a run from one full outer join; closed
versions are dealt by a hash of the whole row and pass through.  Both evaluate ``current`` once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def scd_id(key: Column, updated_at: Column) -> Column:
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(text(key), F.lit("|"), text(updated_at)))


def _identity(key: str, cols: list[str]) -> Column:
    """Join key of a row: a hash of its key, or of its values where there is none.  One number, so that a side dealt
    by it meets the other without another exchange; ``_same`` then compares the keys themselves."""
    return F.when(F.col(f"`{key}`").isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in cols])).otherwise(F.xxhash64(F.col(f"`{key}`")))


def _one_row_a_version(current: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    """``current`` with its identity and equal rows once (only rows without key can be equal)."""
    return current.withColumn("_ident", _identity(key, cols or current.columns)).repartition("_ident").distinct()


def _same(key: str) -> Column:
    o, c = F.col(f"`o_{key}`"), F.col(f"`c_{key}`")
    return F.coalesce(o == c, o.isNull() & c.isNull())  # not an equality to the planner: the identity alone deals


def snapshot_initial(current: DataFrame, key: str = "id", updated_at: str = "updated_at") -> DataFrame:
    """First run: every current row becomes an open version (SN-02), equal rows without key one."""
    u = F.col(updated_at)
    return _one_row_a_version(current, key).drop("_ident").select("*", scd_id(F.col(key), u).alias("dbt_scd_id"), u.alias("dbt_updated_at"),
                          u.alias("dbt_valid_from"), F.lit(None).cast(current.schema[updated_at].dataType)
                          .alias("dbt_valid_to"))


def _schema_union(history: DataFrame, current: DataFrame) -> dict:
    """Source columns of both sides with their types; raises when a type differs."""
    old = {f.name: f.dataType for f in history.schema if f.name not in META}
    new = {f.name: f.dataType for f in current.schema}
    changed = [c for c in old if c in new and old[c].simpleString() != new[c].simpleString()]
    if changed:
        raise ValueError("column types differ from the history: " + ", ".join(
            f"{c} {old[c].simpleString()} -> {new[c].simpleString()}" for c in changed))
    return old | new


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns], F.lit(True).alias(f"{prefix}_row"))


class _Pair:
    """Columns of a joined (old version, current row) pair."""

    def __init__(self, old: DataFrame, current: DataFrame, key: str, updated_at: str):
        self.types, self.key = _schema_union(old, current), key
        self.old_cols, self.cur_cols = [c for c in old.columns if c not in META], current.columns
        self.shared = [c for c in self.old_cols if c in self.cur_cols]
        self.open_type = old.schema["dbt_valid_to"].dataType
        self.has_old, self.has_cur = F.col("o__row").isNotNull(), F.col("c__row").isNotNull()
        self.updated = F.col(f"`c_{updated_at}`")
        self.newer = F.coalesce(self.updated > F.col("o_dbt_updated_at"), F.lit(False))

    def version(self, prefix: str, have: list[str], *meta: Column) -> Column:
        cols = [(F.col(f"`{prefix}{x}`") if x in have else F.lit(None).cast(t)).alias(x) for x, t in self.types.items()]
        return F.struct(*cols, *[m.alias(n) for n, m in zip(META, meta)])

    def old(self, valid_to: Column) -> Column:
        return self.version("o_", self.old_cols, F.col("o_dbt_scd_id"), F.col("o_dbt_updated_at"), F.col("o_dbt_valid_from"), valid_to)

    def new(self) -> Column:
        return self.version("c_", self.cur_cols, scd_id(F.col(f"`c_{self.key}`"), self.updated), self.updated, self.updated,
                            F.lit(None).cast(self.open_type))


def snapshot_delta(open_: DataFrame | None, current: DataFrame, key: str = "id", updated_at: str = "updated_at") -> DataFrame:
    """What a run adds to the history: the versions it opens, and the versions it closes with their end.

    ``open_`` holds the open versions before the run (None: no run before).  Columns new in ``current`` are NULL in
    older versions, columns it lacks are NULL in new ones.
    """
    if open_ is None:
        return snapshot_initial(current, key, updated_at)
    p = _Pair(open_, current, key, updated_at)
    o = _side(open_.withColumn("_ident", _identity(key, p.shared)), "o_")
    c = _side(_one_row_a_version(current, key, p.shared), "c_")
    j = c.join(o, (F.col("c__ident") == F.col("o__ident")) & _same(key), "left")
    opened = ~p.has_old | p.newer
    rows = F.array_compact(F.array(F.when(p.has_old & p.newer, p.old(p.updated)), F.when(opened, p.new())))
    return j.where(opened).select(F.explode(rows).alias("v")).select("v.*")


def snapshot_merge(history: DataFrame | None, current: DataFrame, key: str = "id",
                   updated_at: str = "updated_at") -> DataFrame:
    """Merge ``current`` into ``history`` (SN-01); ``history=None`` is the first run."""
    if history is None:
        return snapshot_initial(current, key, updated_at)
    p = _Pair(history, current, key, updated_at)
    closed = F.col("dbt_valid_to").isNotNull()
    # closed versions meet nothing; they are dealt by a hash of the whole row, not by their key
    spread = F.when(closed, F.xxhash64(*[F.col(f"`{c}`") for c in history.columns])).otherwise(_identity(key, p.shared))
    o = _side(history.withColumn("_ident", spread), "o_")
    c = _side(_one_row_a_version(current, key, p.shared), "c_")
    j = o.join(c, (F.col("o__ident") == F.col("c__ident")) & F.col("o_dbt_valid_to").isNull() & _same(key), "full_outer")
    ends = F.when(p.has_cur & p.newer, p.updated).otherwise(F.col("o_dbt_valid_to"))
    rows = F.array_compact(F.array(F.when(p.has_old, p.old(ends)), F.when(p.has_cur & (~p.has_old | p.newer), p.new())))
    return j.select(F.explode(rows).alias("v")).select("v.*")
