"""Data-quality checks.  A check is a DataFrame of violating rows; empty = pass.

``dq_report`` evaluates a binding of checks to tables and returns one row per
check with its violation count.  Checks never stop a run: a failing check is
reported with status ``warn`` (or ``fail`` for severity ``error``).

Scale notes: key-level checks on the same key columns share one grouped
aggregate, and the row-level checks of the table (not-null, allowed values,
signs) are counted inside the first of them, so a table is scanned once for
both kinds (one plain aggregate when it has no key-level check); each
aggregate yields all its report rows at once.  Cross-table checks are
anti-joins or one grouped join.  Every count is a partial/final aggregate.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import is_not_true
from strata.operators.joins import gate_violations, left_join, orphans


def _names(xs) -> list[str]:
    if isinstance(xs, str):
        return [x.strip() for x in xs.split(",")]
    return list(xs)


# ---------------------------------------------------------------- predicates (row level)
def _not_null_pred(col: str) -> Column:
    return F.col(col).isNull()


def _values_pred(col: str, allowed: Sequence[str]) -> Column:
    # NULL passes: NOT IN yields NULL, which is not a violation.
    return ~F.lower(F.col(col).cast("string")).isin(*[a.lower() for a in allowed])


def _signs_pred(type_col: str, amount_col: str, deposit: str, withdraw: str) -> Column:
    t = F.lower(F.col(type_col))
    a = F.col(amount_col)
    return ((t == deposit) & (a < 0)) | ((t == withdraw) & (a > 0))


def _varies(*cols: str) -> Column:
    """Aggregate: whether the rows hold more than one combination of ``cols`` (a NULL is a value).

    So it is when one of them has two values or a value and a NULL: extremes and counts tell, without
    the second exchange of a distinct count.
    """
    out = F.lit(False)
    for c in cols:
        some = F.count(F.col(c))
        out = out | F.coalesce(F.min(c) != F.max(c), F.lit(False)) | ((some > 0) & (some < F.count(F.lit(1))))
    return out


# ---------------------------------------------------------------- checks
# DQ-01
def unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values occurring more than once: (value, n_records)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


# DQ-02
def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(_not_null_pred(col))


# DQ-03
def values_in_ci(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    return df.where(_values_pred(col, allowed))


# DQ-04
def ref_integrity(df: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Non-NULL foreign keys without a parent row, as column ``fk``."""
    return orphans(df.select(F.col(fk).alias("fk")), parent, "fk", pk)


# DQ-05 — same body as the strict form in the reference project.
ref_integrity_nullable = ref_integrity


# DQ-06
def functional_dependency(df: DataFrame, determinant, dependents) -> DataFrame:
    """Determinants with more than one combination of dependents (NULLs count)."""
    ks, vs = _names(determinant), _names(dependents)
    return (df.groupBy(*ks).agg(F.count_distinct(F.struct(*[F.col(v) for v in vs])).alias("combos"))
              .where(F.col("combos") > 1))


# DQ-07
def unique_by_key(df: DataFrame, keys) -> DataFrame:
    ks = _names(keys)
    return df.groupBy(*ks).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


# DQ-08
def txn_signs_consistent(df: DataFrame, type_col: str = "type", amount_col: str = "amount",
                         deposit: str = "deposit", withdraw: str = "withdraw") -> DataFrame:
    return df.where(_signs_pred(type_col, amount_col, deposit, withdraw))


# DQ-09
def one_to_one(df: DataFrame, left: str, right: str) -> DataFrame:
    """Left values with several right values, then right values with several left ones."""
    pairs = df.where(F.col(left).isNotNull() & F.col(right).isNotNull()) \
              .select(F.col(left).alias("l"), F.col(right).alias("r"))
    vl = pairs.groupBy("l").agg(_varies("r").alias("_v")).where("_v").select("l")
    vr = pairs.groupBy("r").agg(_varies("l").alias("_v")).where("_v").select(F.col("r").alias("l"))
    return vl.unionAll(vr)


# DQ-10 / DQ-12
def no_txn_before_kyc(txn: DataFrame, players: DataFrame, ts_col: str = "txn_timestamp",
                      unknown_is_violation: bool = False) -> DataFrame:
    return gate_violations(txn, players, ts_col=ts_col, unknown_is_violation=unknown_is_violation)


# DQ-11
def code_consistent(players: DataFrame, affiliates: DataFrame, code_col: str = "affiliate_code_redeemed",
                    fk: str = "affiliate_id", pk: str = "id", aff_code: str = "code") -> DataFrame:
    """Players whose redeemed code differs from the code of their affiliate.

    Affiliates are reduced to one code per id (smallest normalised code) first.
    """
    from strata.functions.cleaning import normalize_code

    codes = (affiliates.where(F.col(pk).isNotNull() & F.col(aff_code).isNotNull())
                       .groupBy(F.col(pk).alias("_aid")).agg(F.min(normalize_code(aff_code)).alias("_acode")))
    j = left_join(players, codes, fk, "_aid")
    bad = (F.col(fk).isNotNull() & F.col(code_col).isNotNull()
           & ~normalize_code(code_col).eqNullSafe(F.col("_acode")))
    return j.where(bad).drop("_aid", "_acode")


# DQ-13
def min_rows(df: DataFrame, n: int) -> DataFrame:
    """One row (row_count, min_rows) when the table has fewer than ``n`` rows."""
    return (df.agg(F.count(F.lit(1)).alias("row_count"))
              .where(F.col("row_count") < n).select("row_count", F.lit(n).cast("bigint").alias("min_rows")))


# ---------------------------------------------------------------- report (DQ-14)
@dataclass(frozen=True)
class Check:
    layer: str
    table: str
    kind: str                      # unique | not_null | values_in_ci | ref_integrity | ...
    columns: tuple = ()
    args: dict = field(default_factory=dict, hash=False, compare=False)
    severity: str = "warn"


def reference_checks() -> list[Check]:
    """The checks the warehouse project binds to its models."""
    C = Check
    return [
        C("bronze", "br_affiliates", "unique", ("id",)), C("bronze", "br_affiliates", "not_null", ("id",)),
        C("bronze", "br_players", "unique", ("id",)), C("bronze", "br_players", "not_null", ("id",)),
        C("bronze", "br_players", "not_null", ("country_code",)),
        C("bronze", "br_transactions", "unique", ("id",)), C("bronze", "br_transactions", "not_null", ("id",)),
        C("bronze", "br_transactions", "values_in_ci", ("type",), {"allowed": ("deposit", "withdraw")}),
        C("silver", "sl_affiliates", "unique", ("id",)), C("silver", "sl_affiliates", "not_null", ("id",)),
        C("silver", "sl_affiliates", "functional_dependency", ("id",), {"dependents": ("code", "origin", "redeemed_at")}),
        C("silver", "sl_players", "ref_integrity_nullable", ("affiliate_id",), {"parent": "sl_affiliates", "pk": "id"}),
        C("silver", "sl_players", "unique", ("id",)), C("silver", "sl_players", "not_null", ("id",)),
        C("silver", "sl_players", "not_null", ("country_code",)),
        C("silver", "sl_affiliate_player_bridge", "one_to_one", ("affiliate_id", "player_id")),
        C("silver", "sl_affiliate_player_bridge", "ref_integrity", ("player_id",), {"parent": "sl_players", "pk": "id"}),
        C("silver", "sl_transactions", "no_txn_before_kyc", ("txn_timestamp",), {"players": "sl_players"}),
        C("silver", "sl_transactions", "ref_integrity", ("player_id",), {"parent": "sl_players", "pk": "id"}),
        C("silver", "sl_transactions", "not_null", ("amount",)),
        C("gold", "g_player_daily_balance", "unique_by_key", ("player_id", "txn_date")),
        C("gold", "g_player_daily_balance", "not_null", ("deposits",)),
        C("gold", "g_player_daily_balance", "not_null", ("withdrawals",)),
        C("gold", "g_country_deposits_discord", "not_null", ("country_code",)),
        C("gold", "g_top3_player_deposits", "unique_by_key", ("player_id", "rank_position")),
        C("gold", "g_top3_player_deposits", "not_null", ("top_deposit_amount",)),
    ]


_ROW_LEVEL = {"not_null", "values_in_ci", "txn_signs_consistent"}
_KEY_LEVEL = {"unique", "unique_by_key", "functional_dependency"}
_PARENT_LEVEL = {"ref_integrity", "ref_integrity_nullable", "no_txn_before_kyc"}


def _parent_key(c: Check) -> tuple[str, str, str]:
    """(foreign key, parent table, parent key) of a check against a parent table."""
    if c.kind == "no_txn_before_kyc":
        return "player_id", c.args["players"], "id"
    return c.columns[0], c.args["parent"], c.args["pk"]


def _parent_counts(df: DataFrame, parent: DataFrame, fk: str, pk: str, cs: Sequence[Check]) -> DataFrame:
    """Violations of all ``cs`` (columns _p0, _p1, …) from one left join with their parent.

    Equal to the standalone checks for a parent with repeated keys too: an orphan comes
    once, a matched row once per parent row as in their inner join.
    """
    gated = any(c.kind == "no_txn_before_kyc" for c in cs)
    p = parent.select(F.col(pk).alias("_gk"), *([F.col("is_kyc_approved").alias("_gflag"),
                                                 F.col("kyc_approved_at").alias("_gat")] if gated else []))
    known = F.col("_gk").isNotNull()
    aggs = []
    for i, c in enumerate(cs):
        if c.kind == "no_txn_before_kyc":
            bad = is_not_true(F.col("_gflag")) | (F.col(c.columns[0]) < F.col("_gat"))
            if not c.args.get("unknown_is_violation", False):
                bad = known & bad
        else:
            bad = F.col(fk).isNotNull() & ~known
        aggs.append(F.count_if(bad).alias(f"_p{i}"))
    need = dict.fromkeys([fk, *[c.columns[0] for c in cs if c.kind == "no_txn_before_kyc"]])
    return left_join(df.select(*need), p, fk, "_gk").agg(*aggs)


def _row_pred(c: Check) -> Column:
    if c.kind == "not_null":
        return _not_null_pred(c.columns[0])
    if c.kind == "values_in_ci":
        return _values_pred(c.columns[0], c.args["allowed"])
    return _signs_pred(c.columns[0], c.columns[1], c.args.get("deposit", "deposit"), c.args.get("withdraw", "withdraw"))


def dq_report(tables: dict[str, DataFrame], checks: Sequence[Check] | None = None,
              layers: Sequence[str] | None = None) -> DataFrame:
    """Run ``checks`` against ``tables``: (layer, table_name, check_name, columns, violations, status)."""
    checks = list(checks if checks is not None else reference_checks())
    if layers:
        checks = [c for c in checks if c.layer in layers]
    parts: list[DataFrame] = []

    def meta(c: Check, count_col: Column) -> list[Column]:
        status = F.when(count_col == 0, "pass").otherwise("fail" if c.severity == "error" else "warn")
        return [F.lit(c.layer).alias("layer"), F.lit(c.table).alias("table_name"), F.lit(c.kind).alias("check_name"),
                F.lit(",".join(c.columns)).alias("columns"), count_col.cast("bigint").alias("violations"),
                status.alias("status")]

    by_table: OrderedDict[str, list[Check]] = OrderedDict()
    for c in checks:
        by_table.setdefault(c.table, []).append(c)

    def rows(agg: DataFrame, pairs: list[tuple[Check, str]]) -> DataFrame:
        """One report row per (check, count column) of a one-row aggregate."""
        recs = F.array(*[F.struct(*meta(c, F.coalesce(F.col(col), F.lit(0)))) for c, col in pairs])
        return agg.select(F.explode(recs).alias("_r")).select("_r.*")

    for tname, cs in by_table.items():
        df = tables[tname]
        rl = [c for c in cs if c.kind in _ROW_LEVEL]
        row_aggs = [F.count_if(_row_pred(c)).alias(f"_c{i}") for i, c in enumerate(rl)]
        groups: OrderedDict[tuple, list[Check]] = OrderedDict()
        for c in cs:
            if c.kind in _KEY_LEVEL:
                groups.setdefault(tuple(c.columns), []).append(c)
        if not groups and rl:
            # 1) row-level checks only: one aggregate over one scan of the table
            parts.append(rows(df.agg(*row_aggs), [(c, f"_c{i}") for i, c in enumerate(rl)]))
        # 2) key-level checks sharing key columns: one grouped aggregate per key
        #    set; the first one also counts the row-level checks (per group, then
        #    summed), so such a table is scanned once for both kinds
        for gi, (keys, kcs) in enumerate(groups.items()):
            aggs = [F.count(F.lit(1)).alias("_n")]
            for j, c in enumerate(kcs):
                if c.kind == "functional_dependency":
                    aggs.append(_varies(*c.args["dependents"]).alias(f"_fd{j}"))
            with_rows = gi == 0 and rl
            g = df.groupBy(*keys).agg(*aggs, *(row_aggs if with_rows else []))
            flags = []
            for j, c in enumerate(kcs):
                if c.kind == "unique":
                    flags.append(F.count_if(F.col(keys[0]).isNotNull() & (F.col("_n") > 1)).alias(f"_k{j}"))
                elif c.kind == "unique_by_key":
                    flags.append(F.count_if(F.col("_n") > 1).alias(f"_k{j}"))
                else:
                    flags.append(F.count_if(F.col(f"_fd{j}")).alias(f"_k{j}"))
            pairs = [(c, f"_k{j}") for j, c in enumerate(kcs)]
            if with_rows:
                flags += [F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(rl))]
                pairs += [(c, f"_c{i}") for i, c in enumerate(rl)]
            parts.append(rows(g.agg(*flags), pairs))
        # 3) checks against a parent table: one join per (foreign key, parent)
        parents: OrderedDict[tuple, list[Check]] = OrderedDict()
        for c in cs:
            if c.kind in _PARENT_LEVEL:
                parents.setdefault(_parent_key(c), []).append(c)
        for (fk, parent, pk), pcs in parents.items():
            parts.append(rows(_parent_counts(df, tables[parent], fk, pk, pcs),
                              [(c, f"_p{i}") for i, c in enumerate(pcs)]))
        # 4) pair checks and the rest
        for c in cs:
            if c.kind in _ROW_LEVEL or c.kind in _KEY_LEVEL or c.kind in _PARENT_LEVEL:
                continue
            if c.kind == "one_to_one":
                v = one_to_one(df, c.columns[0], c.columns[1])
            elif c.kind == "min_rows":
                v = min_rows(df, c.args["n"])
            elif c.kind == "code_consistent":
                v = code_consistent(df, tables[c.args["affiliates"]], code_col=c.columns[0])
            else:
                raise ValueError(f"unknown check kind {c.kind}")
            parts.append(v.agg(F.count(F.lit(1)).alias("_v")).select(*meta(c, F.col("_v"))))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
