"""The rule-based cleaning job over the three raw domain tables (CL-01..10).

Rules run in a fixed order and each sees the survivors of the former ones:

  1 coerce types      flag → boolean, dates → UTC timestamps
  2 unique ids        keep the first row per id (input order)
  3 orphan txn        drop transactions of unknown players
  4 unique codes      keep the first affiliate per code
  5 unknown codes     redeemed codes not among affiliate codes → NULL
  6 bad owner         drop affiliates whose owner player is unknown (NULL too)
  7 not approved      drop transactions of players not approved (NULL = not)
  8 before approval   drop transactions dated before approval (NULL date keeps)

Column roles are explicit (``Roles``); a missing role skips its rules.  Instead
of materialising a frame per rule, every row is labelled with the first rule
that removes it — one join for transactions, one pass per key for the others —
so survivors and the audit come from the same plan.  On the two tables that
grow with the data (players, transactions) rule 2 keeps the first row per id
from one partial aggregate and only counts the dropped rows (``_dups``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import ISO, coerce_bool, infer_datetime_formats, parse_datetime_utc
from strata.operators.dedup import first_per_key
from strata.operators.joins import left_join


@dataclass(frozen=True)
class Roles:
    aff_id: str | None = "id"
    ply_id: str | None = "id"
    txn_id: str | None = "id"
    aff_owner: str | None = None
    txn_player_fk: str | None = "player_id"
    aff_code: str | None = "code"
    ply_redeemed_code: str | None = None
    ply_kyc_bool: str | None = "is_kyc_approved"
    ply_kyc_date: str | None = None
    txn_date: str | None = "timestamp"


@dataclass
class CleanResult:
    affiliates: DataFrame
    players: DataFrame
    transactions: DataFrame
    audit: DataFrame
    labelled: dict = field(default_factory=dict)


RULES = ("unique_ids", "orphan_txn", "unique_codes", "null_unknown_codes",
         "drop_bad_owner", "drop_not_approved", "drop_before_approval")


# CL-01
def date_formats(df: DataFrame, cols: Sequence[str | None], order: Sequence) -> dict[str, str]:
    """Formats of the date columns that exist, from their first non-blank values in input order."""
    return infer_datetime_formats(df, [c for c in cols if c and c in df.columns], order)


def coerce_types(p: DataFrame, t: DataFrame, roles: Roles, p_formats: dict[str, str] | None = None,
                 t_formats: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    if roles.ply_kyc_bool and roles.ply_kyc_bool in p.columns:
        p = p.withColumn(roles.ply_kyc_bool, coerce_bool(roles.ply_kyc_bool))
    if roles.ply_kyc_date and roles.ply_kyc_date in p.columns:
        p = p.withColumn(roles.ply_kyc_date, parse_datetime_utc(roles.ply_kyc_date, (p_formats or {}).get(roles.ply_kyc_date, ISO)))
    if roles.txn_date and roles.txn_date in t.columns:
        t = t.withColumn(roles.txn_date, parse_datetime_utc(roles.txn_date, (t_formats or {}).get(roles.txn_date, ISO)))
    return p, t


def _label(*pairs: tuple[Column, str]) -> Column:
    expr = None
    for cond, name in pairs:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr if expr is not None else F.lit(None).cast("string")


def _first_rows(df: DataFrame, key: str | None, order: Sequence, dups: str = "_dups", sums: Sequence[str] = ()) -> DataFrame:
    """First row per ``key`` with ``dups`` = rows of the key dropped (CL-02/CL-04: one
    partial aggregate, the dropped rows only counted; their ``sums`` stay in the total)."""
    if not key or key not in df.columns:
        return df.withColumn(dups, F.lit(0).cast("bigint"))
    return first_per_key(df, key, order, dups, sums)


def label_players(p: DataFrame, roles: Roles, order: Sequence) -> DataFrame:
    """First row per player id (rule 2), ``_dups`` counting the dropped ones."""
    return _first_rows(p, roles.ply_id, order).withColumn("_rule", F.lit(None).cast("string"))


def label_affiliates(a: DataFrame, players_kept: DataFrame, roles: Roles, order: Sequence) -> DataFrame:
    """First affiliate per id (rule 2, ``_dups`` = dropped), of those the first per code (rule 4, ``_code_dups`` =
    dropped), labelled by rule 6."""
    survivors = _first_rows(_first_rows(a, roles.aff_id, order), roles.aff_code, order, "_code_dups", ["_dups"])
    if roles.aff_owner and roles.ply_id and roles.aff_owner in a.columns:
        ids = players_kept.select(F.col(roles.ply_id).alias("_owner_id")).where(F.col("_owner_id").isNotNull())
        j = left_join(survivors, ids, roles.aff_owner, "_owner_id")
        survivors = j.withColumn("_rule", _label((F.col("_owner_id").isNull(), "drop_bad_owner"))).drop("_owner_id")
    else:
        survivors = survivors.withColumn("_rule", F.lit(None).cast("string"))
    return survivors


def null_unknown_codes(players: DataFrame, affiliates_kept: DataFrame, roles: Roles) -> DataFrame:
    """Rule 5: redeemed codes that no kept affiliate has become NULL; ``_code_nulled`` flags them."""
    c = roles.ply_redeemed_code
    if not (c and roles.aff_code and c in players.columns):
        return players.withColumn("_code_nulled", F.lit(False))
    codes = affiliates_kept.select(F.col(roles.aff_code).alias("_known")).where(F.col("_known").isNotNull()).distinct()
    j = left_join(players, codes, c, "_known")
    unknown = F.col(c).isNotNull() & F.col("_known").isNull()
    return j.select(*[F.when(unknown, F.lit(None)).otherwise(F.col(x)).alias(x) if x == c else F.col(x)
                      for x in players.columns], unknown.alias("_code_nulled"))


def label_transactions(t: DataFrame, players_kept: DataFrame, roles: Roles, order: Sequence) -> DataFrame:
    """First transaction per id (rule 2, ``_dups`` = dropped duplicates), labelled
    by rules 3, 7, 8 with one join to the kept players."""
    lt = _first_rows(t, roles.txn_id, order)
    fk = roles.txn_player_fk
    if not (fk and roles.ply_id and fk in t.columns):
        return lt.withColumn("_rule", F.lit(None).cast("string"))
    sel = [F.col(roles.ply_id).alias("_pid")]
    if roles.ply_kyc_bool:
        sel.append(F.col(roles.ply_kyc_bool).alias("_pflag"))
    if roles.ply_kyc_date and roles.ply_kyc_date in players_kept.columns:
        sel.append(F.col(roles.ply_kyc_date).alias("_pdate"))
    p = players_kept.select(*sel).where(F.col("_pid").isNotNull())
    j = left_join(lt, p, fk, "_pid")
    rules = [(F.col("_pid").isNull(), "orphan_txn")]
    if roles.ply_kyc_bool:
        rules.append((~F.coalesce(F.col("_pflag"), F.lit(False)), "drop_not_approved"))
    if "_pdate" in [c for c in j.columns] and roles.txn_date:
        rules.append((F.coalesce(F.col(roles.txn_date) < F.col("_pdate"), F.lit(False)), "drop_before_approval"))
    out = j.withColumn("_rule", _label(*rules))
    return out.drop(*[c for c in ("_pid", "_pflag", "_pdate") if c in out.columns])


def clean_domain(a: DataFrame, p: DataFrame, t: DataFrame, roles: Roles = Roles(),
                 order_cols: dict[str, Sequence] | None = None, infer_dates: bool = False,
                 once: Callable[[DataFrame, str], DataFrame] | None = None) -> CleanResult:
    """Run rules 1-8; returns kept tables and the audit (rule, table_name, rows).

    ``order_cols`` gives each table's input order (``affiliates``, ``players``,
    ``transactions``); it decides which duplicate is "first", so it must be given for
    every table whose ids are made unique.  With ``infer_dates`` the first non-blank value of a date column in that order fixes
    its format (one aggregate a table); else dates begin with the year.  ``once`` (such as ``materialize``) writes the
    labelled players, which the players and the transactions that stay are both read from.
    """
    order_cols = order_cols or {}
    for table, key, df in (("affiliates", roles.aff_id, a), ("players", roles.ply_id, p), ("transactions", roles.txn_id, t)):
        if key and key in df.columns and not order_cols.get(table):
            raise ValueError(f"order_cols[{table!r}] is missing: the input order decides which duplicate stays")
    formats = [date_formats(df, cols, order_cols.get(table, [])) if infer_dates else None
               for df, cols, table in ((p, [roles.ply_kyc_date], "players"), (t, [roles.txn_date], "transactions"))]
    p, t = coerce_types(p, t, roles, *formats)
    lp = label_players(p, roles, order_cols.get("players", [roles.ply_id]))
    if once:
        lp = once(lp, "clean-players")
    players_kept = lp.where(F.col("_rule").isNull()).drop("_rule", "_dups")
    la = label_affiliates(a, players_kept, roles, order_cols.get("affiliates", [roles.aff_id]))
    aff_kept = la.where(F.col("_rule").isNull()).drop("_rule", "_dups", "_code_dups")
    # rule 5 runs before rule 6: codes of affiliates that only lack an owner are known
    players_final = null_unknown_codes(players_kept, la, roles)
    lt = label_transactions(t, players_final, roles, order_cols.get("transactions", [roles.txn_id]))
    txn_kept = lt.where(F.col("_rule").isNull()).drop("_rule", "_dups")

    def counts(df: DataFrame, table: str, rules: list[str]) -> DataFrame | None:
        if not rules:
            return None
        # the drops of rules 2 and 4 are counted on the rows that stay
        dups = {"unique_ids": "_dups", "unique_codes": "_code_dups"}
        agg = df.agg(*[F.coalesce(F.sum(dups[r]), F.lit(0)).alias(r) if r in dups
                       else F.count_if(F.col("_rule") == r).alias(r) for r in rules])
        rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).cast("bigint").alias("rows_affected"))
                                   for r in rules]))
        return agg.select(rows.alias("_r")).select("_r.rule", F.lit(table).alias("table_name"), "_r.rows_affected")

    r = roles
    fk_ok = bool(r.txn_player_fk and r.ply_id and r.txn_player_fk in t.columns)
    parts = [
        counts(la, "affiliates", [x for x, on in [("unique_ids", r.aff_id in a.columns if r.aff_id else False),
                                                 ("unique_codes", r.aff_code in a.columns if r.aff_code else False),
                                                 ("drop_bad_owner", bool(r.aff_owner and r.ply_id))] if on]),
        counts(lp, "players", ["unique_ids"] if r.ply_id and r.ply_id in p.columns else []),
        counts(lt, "transactions", [x for x, on in [("unique_ids", bool(r.txn_id and r.txn_id in t.columns)),
                                                   ("orphan_txn", fk_ok),
                                                   ("drop_not_approved", fk_ok and bool(r.ply_kyc_bool)),
                                                   ("drop_before_approval", fk_ok and bool(r.ply_kyc_date and r.txn_date))]
                                      if on]),
    ]
    if r.ply_redeemed_code and r.aff_code:
        parts.append(players_final.agg(F.count_if(F.col("_code_nulled")).cast("bigint").alias("rows_affected"))
                     .select(F.lit("null_unknown_codes").alias("rule"), F.lit("players").alias("table_name"),
                             "rows_affected"))
    parts = [x for x in parts if x is not None]
    audit = parts[0]
    for x in parts[1:]:
        audit = audit.unionAll(x)
    return CleanResult(aff_kept, players_final.drop("_code_nulled"), txn_kept, audit,
                       {"affiliates": la, "players": lp, "transactions": lt})
