"""The layer models: bronze (typed), silver (clean + business rules), gold (marts).

Each model is a function from DataFrames to a DataFrame; nothing is executed
until a sink or an action runs.  Column names and semantics follow the
warehouse models; arguments expose the values those models hard-code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import cleaning as fn
from strata.operators.dedup import deduplicate, top_n
from strata.operators.joins import HOT_ROWS, gate, hot_keys, key_counts, spread

NUMERIC = fn.DEFAULT_NUMERIC


# ---------------------------------------------------------------- bronze
# BR-01
def br_affiliates(raw: DataFrame) -> DataFrame:
    return raw.select(
        fn.to_int64("id").alias("id"),
        fn.clean_string("code").alias("code"),
        fn.clean_string("origin").alias("origin"),
        fn.parse_timestamp_safe("redeemed_at").alias("redeemed_at"),
    )


# BR-02
def br_players(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` carries extra raw columns through (e.g. a version tie-break)."""
    return raw.select(
        fn.to_int64("id").alias("id"),
        fn.to_int64("affiliate_id").alias("affiliate_id"),
        fn.normalize_country_iso2("country_code").alias("country_code"),
        fn.parse_bool_safe("is_kyc_approved").alias("is_kyc_approved"),
        fn.parse_timestamp_safe("created_at").alias("created_at"),
        fn.parse_timestamp_safe("updated_at").alias("updated_at"),
        *[F.col(k) for k in keep],
    )


def _timestamp(raw: DataFrame, col: str):
    """``parse_timestamp_safe``; a column that has been parsed stays, without its way through text (which has years 0 to 9999)."""
    if not isinstance(raw.schema[col].dataType, T.TimestampNTZType):
        return fn.parse_timestamp_safe(col)
    return F.when(F.year(col).between(0, 9999), F.col(col))


# BR-03
def br_transactions(raw: DataFrame, amount_type: str = NUMERIC, ts_col: str = "timestamp") -> DataFrame:
    return raw.select(
        fn.to_int64("id").alias("id"),
        _timestamp(raw, ts_col).alias("timestamp"),
        fn.to_int64("player_id").alias("player_id"),
        fn.clean_string("type").alias("type"),
        fn.parse_numeric_safe("amount", dtype=amount_type).alias("amount"),
    )


# ---------------------------------------------------------------- silver
# SL-01
def sl_affiliates(br: DataFrame) -> DataFrame:
    return deduplicate(br, "id", [F.col("redeemed_at").desc_nulls_last(), F.col("code").asc_nulls_first()])


PLAYER_COLS = ["id", "affiliate_id", "country_code", "is_kyc_approved", "created_at", "updated_at"]


# SL-02
def sl_players(br: DataFrame, tie_break: Sequence = ()) -> DataFrame:
    """Latest version per id; approval time = last update (N12)."""
    latest = deduplicate(br, "id", [F.col("updated_at").desc_nulls_last(),
                                    F.col("created_at").desc_nulls_last()], tie_break)
    return latest.select(*PLAYER_COLS,
                         fn.approved_at("is_kyc_approved", "updated_at", "created_at").alias("kyc_approved_at"))


# SL-03
def sl_affiliate_player_bridge(a: DataFrame, p: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Affiliates ⟕ players on ``p.affiliate_id = a.id`` with the two violation flags.

    ``a`` is unique by ``id`` (sl_affiliates).  Instead of one outer join plus an
    unbounded window over ``affiliate_id`` (a popular affiliate would land in one
    task), the per-affiliate player count is a partial aggregate; matched pairs
    come from an inner join in which an affiliate with more than ``hot_rows`` players is dealt over several tasks (the
    count tells which), unmatched affiliates from the count being absent.
    """
    pk = p.select(F.col("affiliate_id").alias("_aid"), F.col("id").alias("player_id")) \
          .where(F.col("_aid").isNotNull())
    cnt = pk.groupBy("_aid").agg(F.count("player_id").alias("player_ref_count"),
                                 F.count(F.lit(1)).alias("_rows"))
    base = a.select("id", "code", "origin", "redeemed_at")
    ac = base.join(cnt, base.id == cnt._aid, "left")
    # players stream on the left side: a sort-merge join buffers only the
    # right side's rows of a key, here one affiliate row
    l, r = spread(pk, ac.where(F.col("_rows").isNotNull()).drop("_rows").withColumnRenamed("_aid", "_ref"),
                  hot_keys(cnt, ["_aid"], "_rows", hot_rows), ["_aid"], ["_ref"])
    linked = l.join(r, (l["_aid"] == r["_ref"]) & (l["_ls"] == r["_rs"]), "inner")
    unlinked = (ac.where(F.col("_rows").isNull())
                  .select(*base.columns, F.lit(None).cast("bigint").alias("player_id"),
                          F.lit(0).cast("bigint").alias("player_ref_count")))
    bridge = linked.select(*base.columns, "player_id", "player_ref_count").unionByName(unlinked)
    return bridge.select(
        F.col("id").alias("affiliate_id"), "code", "origin", "redeemed_at", "player_id",
        F.when(F.col("redeemed_at").isNotNull() & F.col("player_id").isNull(), 1).otherwise(0)
         .alias("is_violation_unlinked_redeemed"),
        "player_ref_count",
        F.when(F.col("player_ref_count") > 1, 1).otherwise(0).alias("is_violation_affiliate_not_1to1"),
    )


# SL-04
def sl_transactions(br_t: DataFrame, sl_p: DataFrame, measured: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Transactions of approved players at or after their approval time.

    Many-to-one join on ``player_id``; the players side is reduced to approved
    rows first (filter pushdown).  Broadcast is left to AQE's measured size.  With ``measured`` (for a written table, where
    counting reads one column) a hot player's transactions are dealt by their count; else a fixed salt
    and AQE's skew join split them.
    """
    counts = key_counts(br_t, "player_id") if measured else None
    return (gate(br_t, sl_p, ts_col="timestamp", counts=counts, bound=hot_rows)
            .select("id", F.col("timestamp").alias("txn_timestamp"), "player_id", "type", "amount"))


# ---------------------------------------------------------------- gold
# GD-01
def player_daily_balance(t: DataFrame, deposit: str = fn.DEPOSIT, withdraw: str = fn.WITHDRAW) -> DataFrame:
    dep, wd = fn.conditional_amounts("type", "amount", deposit, withdraw)
    return (t.select("player_id", fn.txn_day("txn_timestamp").alias("txn_date"),
                     dep.alias("deposit_amount"), wd.alias("withdrawal_amount"))
             .groupBy("player_id", "txn_date")
             .agg(F.sum("deposit_amount").alias("deposits"), F.sum("withdrawal_amount").alias("withdrawals")))


# GD-02
def country_deposits(p: DataFrame, a: DataFrame, t: DataFrame,
                     origin: str = "discord", txn_type: str = fn.DEPOSIT) -> DataFrame:
    """Approved players of affiliates from ``origin``: count and sum of ``txn_type`` per country.

    The filter on the affiliate side turns the model's left join into an inner
    one.  Transactions are pre-aggregated per player before joining, so the
    large side ships one partial row per player and map partition.
    """
    per_player = (t.where(F.lower("type") == txn_type)
                   .groupBy(F.col("player_id").alias("_pid"))
                   .agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_s")))
    aff = a.where(F.lower("origin") == origin).select(F.col("id").alias("_aid"))
    pl = (p.where(F.col("is_kyc_approved") == F.lit(True))
           .select("id", "affiliate_id", "country_code"))
    j = pl.join(aff, pl.affiliate_id == aff._aid).join(per_player, F.col("id") == F.col("_pid"))
    return j.groupBy("country_code").agg(F.sum("_n").alias("deposit_count"), F.sum("_s").alias("deposit_sum"))


# GD-03
def top_player_deposits(t: DataFrame, n: int = 3, txn_type: str = fn.DEPOSIT) -> DataFrame:
    d = t.where(F.lower("type") == txn_type).select("player_id", "amount")
    ranked = top_n(d, "player_id", [F.col("amount").desc()], n, "rank_position")
    return ranked.select("player_id", F.col("amount").alias("top_deposit_amount"), "rank_position")


# ---------------------------------------------------------------- whole layer sets
def bronze(raw_a: DataFrame, raw_p: DataFrame, raw_t: DataFrame, amount_type: str = NUMERIC,
           player_keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    return {"br_affiliates": br_affiliates(raw_a),
            "br_players": br_players(raw_p, player_keep),
            "br_transactions": br_transactions(raw_t, amount_type)}


def silver(br: dict[str, DataFrame], tie_break: Sequence = ()) -> dict[str, DataFrame]:
    a = sl_affiliates(br["br_affiliates"])
    p = sl_players(br["br_players"], tie_break)
    return {"sl_affiliates": a, "sl_players": p,
            "sl_affiliate_player_bridge": sl_affiliate_player_bridge(a, p),
            "sl_transactions": sl_transactions(br["br_transactions"], p)}


def gold(sl: dict[str, DataFrame], origin: str = "discord", n: int = 3) -> dict[str, DataFrame]:
    t = sl["sl_transactions"]
    return {"g_player_daily_balance": player_daily_balance(t),
            "g_country_deposits_discord": country_deposits(sl["sl_players"], sl["sl_affiliates"], t, origin),
            "g_top3_player_deposits": top_player_deposits(t, n)}
