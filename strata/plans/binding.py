"""Binding of the driver's TPC-H-like tables to the three raw domains.

The raw views imitate headered CSV input: every domain column is text, with
the dirt the cleaning functions exist for (padding, ``$`` in amounts, NULL and
3-letter countries, several boolean spellings, duplicate ids, several versions
per player, dangling links).  ``version_id`` is an extra, stable tie-break.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import run_concurrently
from strata.sources.tables import read_table

# Fixed values of the binding (FIXTURES §3).
ORIGIN_BY_NATION_MOD4 = {0: "Discord", 1: "YouTube", 2: "X"}  # 3 → NULL
NATION_CODES = ["at", "be", "ch", "cz", "dk", "ee", "fi", "gr", "hr", "hu", "ie", "it", "lt", "lv", "nl",
                 "at", "be", "ch", "cz", "dk", "ee", "fi", "gr", "hr", "hu"]  # by nation key, lower case on purpose
THREE_LETTER_NATION = 24
THREE_LETTER_CODE = "BRA"
KYC_BY_STATUS = {"F": "TRUE", "O": "no", "P": ""}
TYPE_BY_RETURNFLAG = {"A": " Deposit", "R": "Withdraw", "N": "bet"}


def _case(col, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def raw_affiliates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    first_ship = (read_table(spark, sf_dir, "lineitem")
                  .groupBy("l_suppkey").agg(F.min("l_shipdate").alias("_first_ship")))
    j = s.join(first_ship, s.s_suppkey == first_ship.l_suppkey, "left")
    return j.select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.concat(F.lit("  "), F.col("s_name"), F.lit("  ")).alias("code"),
        _case(F.col("s_nationkey") % 4, ORIGIN_BY_NATION_MOD4).alias("origin"),
        F.when(F.col("s_acctbal") >= 0, F.col("_first_ship").cast("string")).alias("redeemed_at"),
    )


def raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    created = o.groupBy(F.col("o_custkey").alias("_ck")).agg(F.min("o_orderdate").alias("_created"))
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(created, F.col("_ck") == F.col("c_custkey")))
    g = F.floor(F.col("c_custkey") / 10)
    limit = F.when(g % 4 == 0, 0).when(g % 4 == 1, 1).otherwise(8)
    country = F.when(F.col("c_nationkey") == THREE_LETTER_NATION, F.lit(THREE_LETTER_CODE)).otherwise(
        F.concat(F.lit(" "), F.element_at(F.array(*[F.lit(x) for x in NATION_CODES]), (F.col("c_nationkey") + 1).cast("int"))))
    return j.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_custkey") % 10 < limit, g.cast("string")).alias("affiliate_id"),
        country.alias("country_code"),
        _case(F.col("o_orderstatus"), KYC_BY_STATUS).alias("is_kyc_approved"),
        F.col("_created").cast("string").alias("created_at"),
        F.col("o_orderdate").cast("string").alias("updated_at"),
        F.col("o_orderkey").alias("version_id"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"),
        F.col("l_shipdate").cast("string").alias("timestamp"),
        F.col("o_custkey").cast("string").alias("player_id"),
        _case(F.col("l_returnflag"), TYPE_BY_RETURNFLAG).alias("type"),
        F.concat(F.lit("$"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("amount"),
    )


def raw_domain(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return raw_affiliates(spark, sf_dir), raw_players(spark, sf_dir), raw_transactions(spark, sf_dir)


# Settings of the driver queries: exact 2-digit amounts and a stable version tie-break.
DRIVER_AMOUNT = "decimal(18,2)"


def driver_tie_break():
    return [F.col("version_id").desc()]


class Domain(Mapping):
    """Read-only mapping name → DataFrame whose entries are built on first access
    (and memoised) from the entries they depend on, so a query pays driver-side
    analysis only for the tables it uses."""

    def __init__(self, factories: dict[str, Callable[["Domain"], DataFrame]]):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name](self)
        return self._built[name]

    def __contains__(self, name: object) -> bool:   # without building the entry
        return name in self._factories

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


# Tables of a layer in dependency order: each wave only needs earlier waves.
WAVES = {
    "bronze": [["br_affiliates", "br_players", "br_transactions"]],
    "silver": [["sl_affiliates", "sl_players"], ["sl_affiliate_player_bridge", "sl_transactions"]],
    "gold": [["g_player_daily_balance", "g_country_deposits_discord", "g_top3_player_deposits"]],
}


def domain(spark: SparkSession, sf_dir: str, layers: str = "bronze,silver,gold",
           materialize: str = "") -> Domain:
    """Raw, bronze, silver and gold tables over the bound driver tables.

    Lazy: an entry is built when first used.  Layers named in ``materialize``
    (e.g. ``"silver"``) are written once (Parquet in the shared checkpoint
    folder) and later layers are built on the written tables, as the pipeline
    does: for consumers that scan a layer many times.
    """
    from strata.plans import layers as L
    from strata.sources.io import materialize as write_once

    tie = driver_tie_break()
    f: dict[str, tuple[str, Callable[[Domain], DataFrame]]] = {
        "raw_affiliates": ("raw", lambda d: raw_affiliates(spark, sf_dir)),
        "raw_players": ("raw", lambda d: raw_players(spark, sf_dir)),
        "raw_transactions": ("raw", lambda d: raw_transactions(spark, sf_dir)),
        "br_affiliates": ("bronze", lambda d: L.br_affiliates(d["raw_affiliates"])),
        "br_players": ("bronze", lambda d: L.br_players(d["raw_players"], ("version_id",))),
        "br_transactions": ("bronze", lambda d: L.br_transactions(d["raw_transactions"], DRIVER_AMOUNT)),
        "sl_affiliates": ("silver", lambda d: L.sl_affiliates(d["br_affiliates"])),
        "sl_players": ("silver", lambda d: L.sl_players(d["br_players"], tie)),
        "sl_affiliate_player_bridge": ("silver", lambda d: L.sl_affiliate_player_bridge(d["sl_affiliates"],
                                                                                         d["sl_players"])),
        "sl_transactions": ("silver", lambda d: L.sl_transactions(d["br_transactions"], d["sl_players"])),
        "g_player_daily_balance": ("gold", lambda d: L.player_daily_balance(d["sl_transactions"])),
        "g_country_deposits_discord": ("gold", lambda d: L.country_deposits(d["sl_players"], d["sl_affiliates"],
                                                                             d["sl_transactions"])),
        "g_top3_player_deposits": ("gold", lambda d: L.top_player_deposits(d["sl_transactions"])),
    }
    wanted = {"raw", "bronze"}
    if "silver" in layers or "gold" in layers:
        wanted.add("silver")
    if "gold" in layers:
        wanted.add("gold")

    def wrap(name: str, layer: str, fn: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
        if layer in materialize:
            return lambda d: write_once(fn(d), name)
        return fn

    dom = Domain({name: wrap(name, layer, fn) for name, (layer, fn) in f.items() if layer in wanted})
    # write materialised layers up front, independent tables as concurrent jobs
    for layer in ("bronze", "silver", "gold"):
        if layer in materialize and layer in wanted:
            for wave in WAVES[layer]:
                run_concurrently([lambda n=n: dom[n] for n in wave])
    return dom
