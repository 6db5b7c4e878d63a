"""Named queries over the bound driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Outputs are normalised for comparison with the SQL oracle: decimals become
double at the very end (sums stay exact until then), small integers become
bigint.  Every query reads the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import binding
from strata.plans import layers as L
from strata.session import configure
from strata.sources.csv_records import read_csv_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def normalize_output(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return normalize_output(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def D(spark, sf_dir, layers="bronze,silver,gold"):
    return binding.domain(spark, sf_dir, layers)


# ---------------------------------------------------------------- layer models (§2.8)
for _name, _layers in [("br_affiliates", "bronze"), ("br_players", "bronze"), ("br_transactions", "bronze"),
                       ("sl_affiliates", "silver"), ("sl_players", "silver"),
                       ("sl_affiliate_player_bridge", "silver"), ("sl_transactions", "silver"),
                       ("g_player_daily_balance", "gold"), ("g_country_deposits_discord", "gold"),
                       ("g_top3_player_deposits", "gold")]:
    def _mk(n=_name, ly=_layers):
        def f(spark, sf_dir):
            df = D(spark, sf_dir, ly)[n]
            return df.drop("version_id") if n == "br_players" else df
        f.__doc__ = f"Layer model {n}."
        return f
    query(_name)(_mk())


# ---------------------------------------------------------------- scalar functions (§2.2)
from strata.functions import cleaning as fn  # noqa: E402
from strata.operators import aggregates as AG  # noqa: E402
from strata.operators import dedup as WN  # noqa: E402
from strata.operators import joins as JN  # noqa: E402
from strata.operators import projection as PF  # noqa: E402
from strata.sources.tables import read_table  # noqa: E402


@query("fn_clean_string_lower")
def _fn01(spark, sf_dir):
    """clean_string(text, lower) over whole documents."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", fn.clean_string("text").alias("text_clean"))


@query("fn_clean_string_keep")
def _fn02(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", fn.clean_string("text", to_lower=False).alias("text_clean"))


@query("fn_country_iso2")
def _fn03(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_players"]
    return r.select("version_id", fn.normalize_country_iso2("country_code").alias("country_code"))


@query("fn_parse_timestamp")
def _fn04(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_affiliates"]
    return r.select("id", fn.parse_timestamp_safe("redeemed_at").alias("redeemed_at"))


@query("fn_parse_bool")
def _fn05(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_players"]
    return r.select("version_id", fn.parse_bool_safe("is_kyc_approved").alias("is_kyc_approved"))


@query("fn_parse_numeric")
def _fn06(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_transactions"]
    return r.select("id", fn.parse_numeric_safe("amount", dtype=binding.DRIVER_AMOUNT).alias("amount"))


@query("fn_txn_sign")
def _fn07(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    return b.select("id", "type", fn.normalize_txn_sign("type", "amount").alias("signed_amount"))


@query("fn_kyc_filter")
def _fn08(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    t, p = d["br_transactions"], d["sl_players"]
    j = t.join(p.select(F.col("id").alias("_pid"), "is_kyc_approved", "kyc_approved_at"),
               t.player_id == F.col("_pid"))
    return j.select("id", "player_id",
                    fn.kyc_txn_filter("timestamp", "is_kyc_approved", "kyc_approved_at").alias("passes_gate"))


@query("fn_cast_int64")
def _fn09(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    txt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return o.select("o_orderkey", fn.to_int64(txt).alias("total_int"))


@query("fn_ts_to_date")
def _fn10(spark, sf_dir):
    t = D(spark, sf_dir, "silver")["sl_transactions"]
    return t.select("id", "player_id", fn.txn_day("txn_timestamp").alias("txn_date"))


@query("fn_approved_at")
def _fn11(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_players"]
    return b.select("version_id", fn.approved_at("is_kyc_approved", "updated_at", "created_at").alias("approved_at"))


@query("fn_conditional_amounts")
def _fn12(spark, sf_dir):
    t = D(spark, sf_dir, "silver")["sl_transactions"]
    dep, wd = fn.conditional_amounts("type", "amount")
    return t.select("id", "player_id", dep.alias("deposit_amount"), wd.alias("withdrawal_amount"))


@query("fn_coerce_bool")
def _fn13(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_players"]
    return r.select("version_id", fn.coerce_bool("is_kyc_approved").alias("is_kyc_approved"))


@query("fn_parse_datetime_utc")
def _fn14(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_players"]
    return r.select("version_id", fn.parse_datetime_utc("created_at").alias("created_at"),
                    fn.parse_datetime_utc("is_kyc_approved").alias("not_a_date"))


@query("fn_parse_datetime_formats")
def _fn14_formats(spark, sf_dir):
    """Order dates written in three formats, each with misfits; the first non-blank value fixes a column's format."""
    o = read_table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    texts = o.select("o_orderkey",
                     F.when(k % 5 == 4, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, " MM/dd/yyyy ")).alias("us"),
                     F.when(k % 7 == 6, F.date_format(d, "d/M/yyyy")).when(k % 3 == 0, "  ").otherwise(F.date_format(d, "d MMM yyyy")).alias("named"),
                     F.when(k % 11 == 10, F.date_format(d, "yyyy/MM/dd")).otherwise(F.concat(F.date_format(d, "yyyy/MM/dd"), F.lit(" 7:05 pm"))).alias("timed"))
    cols = ["us", "named", "timed"]
    formats = fn.infer_datetime_formats(texts, cols, ["o_orderkey"])
    return texts.select("o_orderkey", *[fn.parse_datetime_utc(c, formats[c]).alias(c) for c in cols])


@query("fn_blank_to_null")
def _fn15(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_players"]
    return fn.blank_to_null(r.select("version_id", "affiliate_id", "is_kyc_approved"),
                            ["affiliate_id", "is_kyc_approved"])


@query("fn_normalize_code")
def _fn16(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_affiliates"]
    return r.select("id", fn.normalize_code("code").alias("code"), fn.normalize_code("origin").alias("origin"))


@query("fn_to_int_or_null")
def _fn17(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_transactions"]
    return r.select(fn.to_int64("player_id").alias("player_id"),
                    fn.to_int64("amount").alias("amount_raw_int"),
                    fn.to_int64(F.expr("substring(amount, 2)")).alias("amount_int"))


@query("fn_null_safe_neq")
def _fn18(spark, sf_dir):
    p = D(spark, sf_dir, "silver")["sl_players"]
    return p.select("id", fn.is_not_true("is_kyc_approved").alias("not_approved"))


@query("fn_first_non_null")
def _fn19(spark, sf_dir):
    p = D(spark, sf_dir, "silver")["sl_players"]
    return p.select("id", fn.first_non_null("kyc_approved_at", "updated_at", "created_at").alias("best_date"))


@query("fn_timestamp_offset")
def _fn20(spark, sf_dir):
    t = D(spark, sf_dir, "silver")["sl_transactions"]
    return t.select("id", "player_id",
                    fn.offset("txn_timestamp", F.col("player_id") % 10, F.col("id") % 1440).alias("shifted_ts"))


# ---------------------------------------------------------------- projections and filters (§2.3)
@query("pf_typed_projection")
def _pf01(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    return b.select("id", F.col("timestamp").alias("txn_ts"), "player_id",
                    F.col("type").alias("txn_type"), "amount")


@query("pf_star_except")
def _pf02(spark, sf_dir):
    return D(spark, sf_dir, "bronze")["br_players"].drop("version_id")


@query("pf_filter_ci_eq")
def _pf03(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    return b.where(F.lower("type") == "deposit")


@query("pf_bool_time_filter")
def _pf04(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_players"]
    return b.where((F.col("is_kyc_approved") == F.lit(True)) & (F.col("updated_at") > F.col("created_at"))) \
            .select("id", "version_id", "updated_at")


@query("pf_not_in")
def _pf05(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    return b.where(~F.lower("type").isin("deposit", "withdraw"))


@query("pf_null_filter")
def _pf06(spark, sf_dir):
    p = D(spark, sf_dir, "silver")["sl_players"]
    return p.dropna(subset=["country_code", "is_kyc_approved"]).select("id", "country_code", "is_kyc_approved")


@query("pf_conditional_update")
def _pf07(spark, sf_dir):
    a = D(spark, sf_dir, "bronze")["br_affiliates"]
    return PF.set_where(a, "origin", F.col("origin").isNull(), "unknown")


@query("pf_add_missing_column")
def _pf08(spark, sf_dir):
    a = D(spark, sf_dir, "bronze")["br_affiliates"]
    a = PF.ensure_column(PF.ensure_column(a, "owner_player_id", "bigint"), "code", "string")
    return a.withColumn("_helper", F.lit(1)).drop("_helper")


# ---------------------------------------------------------------- joins (§2.4)
@query("jn_inner_gate")
def _jn01(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return JN.gate(d["br_transactions"], d["sl_players"], "timestamp").select("id", "player_id", "timestamp")


@query("jn_left_bridge")
def _jn02(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return d["sl_affiliate_player_bridge"].select("affiliate_id", "player_id")


@query("jn_three_way")
def _jn03(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    p, a, t = d["sl_players"], d["sl_affiliates"], d["sl_transactions"]
    aff = a.where(F.lower("origin") == "discord").select(F.col("id").alias("_aid"), "origin")
    tt = t.where(F.lower("type") == "deposit").select(F.col("player_id").alias("_pid"), "amount", "type")
    j = (p.where(F.col("is_kyc_approved") == F.lit(True))
          .join(aff, F.col("affiliate_id") == F.col("_aid"))
          .join(tt, F.col("id") == F.col("_pid")))
    return j.select(F.col("id").alias("player_id"), "country_code", "origin", "amount", "type")


@query("jn_anti")
def _jn04(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return JN.orphans(d["sl_players"], d["sl_affiliates"], "affiliate_id", "id").select("id", "affiliate_id")


@query("jn_semi")
def _jn05(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return JN.keep_known(d["sl_players"], d["sl_affiliates"], "affiliate_id", "id").select("id", "affiliate_id")


@query("jn_anti_count")
def _jn06(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    approved = d["sl_players"].where(F.col("is_kyc_approved") == F.lit(True))
    parts = [
        JN.orphan_count(d["sl_players"], d["sl_affiliates"], "affiliate_id", "id").select(
            F.lit("players_unknown_affiliate").alias("check_name"), "orphans"),
        JN.orphan_count(d["br_transactions"], approved, "player_id", "id").select(
            F.lit("transactions_unapproved_player").alias("check_name"), "orphans"),
        JN.orphan_count(d["br_affiliates"], d["br_players"], "id", "affiliate_id", null_is_orphan=True).select(
            F.lit("affiliates_without_player").alias("check_name"), "orphans"),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("jn_lookup_flag")
def _jn07(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return JN.lookup(d["br_transactions"].select("id", "player_id"), d["sl_players"], "player_id", "id",
                     ["is_kyc_approved"], default=False)


@query("jn_lookup_fill")
def _jn08(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    first = AG.min_by_key(d["sl_players"], "affiliate_id", "created_at", "first_player_at")
    return JN.fill_from(d["sl_affiliates"], "redeemed_at", first, "id", "first_player_at", "affiliate_id")


@query("jn_left_audit")
def _jn09(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    p = d["sl_players"].select("id", "affiliate_id", "created_at")
    a = d["sl_affiliates"].select("id", "redeemed_at")
    m = JN.mismatches(p, a, ("affiliate_id", "id"),
                      lambda l, r: l["affiliate_id"].isNotNull() & (r["id__r"].isNull() | r["redeemed_at"].isNull()))
    return m.select("id", "affiliate_id", "id__r", "redeemed_at")


@query("jn_inner_violation")
def _jn10(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return JN.gate_violations(d["br_transactions"], d["sl_players"], "timestamp").select("id", "player_id", "timestamp")


# ---------------------------------------------------------------- aggregates (§2.5)
@query("ag_sum_by_keys")
def _ag01(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    return (b.groupBy("player_id", fn.txn_day("timestamp").alias("txn_date"))
             .agg(F.sum("amount").alias("amount_sum"), F.count(F.lit(1)).alias("txn_count")))


@query("ag_count_sum")
def _ag02(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    per_player = d["sl_transactions"].groupBy(F.col("player_id").alias("_pid")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_s"))
    j = d["sl_players"].join(per_player, F.col("id") == F.col("_pid"))
    return j.groupBy("country_code").agg(F.sum("_n").alias("txn_count"), F.sum("_s").alias("amount_sum"))


@query("ag_min_by_code")
def _ag03(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_players"]
    return AG.min_by_key(b, "affiliate_id", "created_at", "first_created_at")


@query("ag_having_count")
def _ag04(spark, sf_dir):
    return AG.duplicate_keys(D(spark, sf_dir, "bronze")["br_transactions"], "id")


@query("ag_having_distinct")
def _ag05(spark, sf_dir):
    return AG.multi_valued(D(spark, sf_dir, "bronze")["br_players"], "id", "is_kyc_approved")


@query("ag_nunique_vs_rows")
def _ag06(spark, sf_dir):
    d = D(spark, sf_dir, "bronze")
    parts = [AG.nunique_vs_rows(d[n], "id").select(F.lit(n).alias("table_name"), "*")
             for n in ("br_affiliates", "br_players", "br_transactions")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("ag_dup_stats")
def _ag07(spark, sf_dir):
    return AG.duplicate_stats(D(spark, sf_dir, "bronze")["br_transactions"], "id")


@query("ag_max_id")
def _ag08(spark, sf_dir):
    d = D(spark, sf_dir, "raw")
    parts = [AG.max_id(d[n], "id").select(F.lit(n).alias("table_name"), "max_id")
             for n in ("raw_affiliates", "raw_players", "raw_transactions")]
    parts.append(AG.max_id(d["raw_players"], "is_kyc_approved").select(F.lit("no_numeric_ids").alias("table_name"), "max_id"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("ag_row_counts")
def _ag09(spark, sf_dir):
    d = D(spark, sf_dir, "gold")
    return AG.row_counts({k: v for k, v in d.items()})


@query("ag_distinct_values")
def _ag10(spark, sf_dir):
    r = D(spark, sf_dir, "raw")["raw_players"]
    return AG.distinct_codes(r, "country_code")


# ---------------------------------------------------------------- windows (§2.6)
TXN_ORDER = ["timestamp", "player_id", "amount", "type"]


@query("wn_dedup_latest")
def _wn01(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    return WN.deduplicate(b, "id", [F.col("timestamp").desc(), F.col("amount").desc()],
                          [F.col("player_id"), F.col("type")])


@query("wn_topn_per_group")
def _wn02(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    r = WN.top_n(b.select("player_id", "amount"), "player_id", [F.col("amount").desc()], 5, "rank_position")
    return r


@query("wn_count_partition")
def _wn03(spark, sf_dir):
    p = D(spark, sf_dir, "silver")["sl_players"].select("id", "affiliate_id")
    return WN.count_over(p, "affiliate_id", "id", "players_of_affiliate")


@query("wn_keep_first")
def _wn04(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    kept, _removed = WN.keep_first(b, "id", TXN_ORDER)
    return kept


@query("wn_keep_first_removed")
def _wn04b(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"]
    _kept, removed = WN.keep_first(b, "id", TXN_ORDER)
    return removed.select("id")


@query("wn_mark_all_duplicates")
def _wn05(spark, sf_dir):
    b = D(spark, sf_dir, "bronze")["br_transactions"].select("id", "player_id", "amount")
    return WN.mark_duplicates(b, "id")


# ---------------------------------------------------------------- sort / set (§2.7)
@query("so_order_output")
def _so01(spark, sf_dir):
    g = D(spark, sf_dir, "gold")["g_top3_player_deposits"]
    return g.orderBy("player_id", "rank_position")


@query("so_preview")
def _so02(spark, sf_dir):
    p = D(spark, sf_dir, "silver")["sl_players"]
    return PF.preview(p, ["id"], 5)


@query("st_union_all")
def _st01(spark, sf_dir):
    b = D(spark, sf_dir, "silver")["sl_affiliate_player_bridge"]
    pairs = b.where(F.col("affiliate_id").isNotNull() & F.col("player_id").isNotNull())
    left = AG.multi_valued(pairs, "affiliate_id", "player_id").select(F.col("affiliate_id").alias("l"))
    right = AG.multi_valued(pairs, "player_id", "affiliate_id").select(F.col("player_id").alias("l"))
    return left.unionAll(right)


@query("st_union_by_name")
def _st02(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    dangling = JN.orphans(d["sl_players"], d["sl_affiliates"], "affiliate_id", "id") \
        .select(F.col("affiliate_id").alias("id")).distinct()
    return PF.append_rows(d["sl_affiliates"], dangling)


# ---------------------------------------------------------------- data-quality checks (§2.10)
from strata.operators import quality as DQ  # noqa: E402


@query("dq_unique")
def _dq01(spark, sf_dir):
    return DQ.unique(D(spark, sf_dir, "bronze")["br_players"], "id")


@query("dq_not_null")
def _dq02(spark, sf_dir):
    return DQ.not_null(D(spark, sf_dir, "silver")["sl_players"], "country_code")


@query("dq_values_in_ci")
def _dq03(spark, sf_dir):
    return DQ.values_in_ci(D(spark, sf_dir, "bronze")["br_transactions"], "type", ["Deposit", "Withdraw"])


@query("dq_ref_integrity")
def _dq04(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return DQ.ref_integrity(d["sl_players"], "affiliate_id", d["sl_affiliates"], "id")


@query("dq_ref_integrity_nullable")
def _dq05(spark, sf_dir):
    d = D(spark, sf_dir, "bronze")
    return DQ.ref_integrity_nullable(d["br_players"], "affiliate_id", d["br_affiliates"], "id")


@query("dq_functional_dependency")
def _dq06(spark, sf_dir):
    return DQ.functional_dependency(D(spark, sf_dir, "bronze")["br_players"], "id", "is_kyc_approved")


@query("dq_functional_dependency_multi")
def _dq06b(spark, sf_dir):
    return DQ.functional_dependency(D(spark, sf_dir, "bronze")["br_players"], "id",
                                    "country_code,is_kyc_approved,created_at")


@query("dq_unique_by_key")
def _dq07(spark, sf_dir):
    return DQ.unique_by_key(D(spark, sf_dir, "bronze")["br_transactions"], "id, player_id")


@query("dq_txn_signs")
def _dq08(spark, sf_dir):
    return DQ.txn_signs_consistent(D(spark, sf_dir, "bronze")["br_transactions"])


@query("dq_one_to_one")
def _dq09(spark, sf_dir):
    return DQ.one_to_one(D(spark, sf_dir, "silver")["sl_affiliate_player_bridge"], "affiliate_id", "player_id")


@query("dq_no_txn_before_kyc")
def _dq10(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return DQ.no_txn_before_kyc(d["sl_transactions"], d["sl_players"], "txn_timestamp")


@query("dq_kyc_left_audit")
def _dq12(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return DQ.no_txn_before_kyc(d["br_transactions"], d["sl_players"], "timestamp", unknown_is_violation=True) \
             .select("id", "player_id", "timestamp")


@query("dq_min_rows")
def _dq13(spark, sf_dir):
    d = D(spark, sf_dir, "silver")
    return DQ.min_rows(d["sl_transactions"], 1000).unionAll(DQ.min_rows(d["sl_players"], 2000))


@query("dq_report")
def _dq14(spark, sf_dir):
    """All checks bound to bronze, silver and gold; soft fail (status warn).

    The checks scan each silver table several times (and gold derives from
    them), so the silver layer is written once, as the pipeline does, and
    checked from its files; bronze tables are single projections of the raw
    scans and stay lazy."""
    return DQ.dq_report(binding.domain(spark, sf_dir, "gold", materialize="silver"))


# ---------------------------------------------------------------- cleaning job (§2.9)
from strata.plans import cleaning_job as CL  # noqa: E402

# Input order of the bound raw tables (the "file order" that decides keep-first).
CLEAN_ORDER = {"affiliates": ["id", "code"], "players": ["version_id"],
               "transactions": ["timestamp", "player_id", "amount", "type"]}
IDS_ONLY = CL.Roles(aff_code=None, txn_player_fk=None, ply_kyc_bool=None, txn_date=None)


def _raw(spark, sf_dir):
    d = D(spark, sf_dir, "raw")
    return d["raw_affiliates"], d["raw_players"], d["raw_transactions"]


@query("cl_coerce_types")
def _cl01(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    _p, t2 = CL.coerce_types(p, t, CL.Roles())
    return t2


@query("cl_unique_ids")
def _cl02(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    return CL.clean_domain(a, p, t, IDS_ONLY, CLEAN_ORDER).audit


@query("cl_orphan_txn")
def _cl03(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    roles = CL.Roles(aff_code=None, ply_kyc_bool=None)
    return CL.clean_domain(a, p, t, roles, CLEAN_ORDER).transactions


@query("cl_unique_codes")
def _cl04(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    return CL.clean_domain(a, p, t, CL.Roles(), CLEAN_ORDER).affiliates


@query("cl_null_unknown_codes")
def _cl05(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    roles = CL.Roles(aff_code="id", ply_redeemed_code="affiliate_id")
    return CL.clean_domain(a, p, t, roles, CLEAN_ORDER).players.select("id", "version_id", "affiliate_id")


@query("cl_drop_bad_owner")
def _cl06(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    return CL.clean_domain(a, p, t, CL.Roles(aff_owner="id"), CLEAN_ORDER).affiliates


@query("cl_drop_not_approved")
def _cl07(spark, sf_dir):
    """Against sl_players, without the other rules."""
    d = D(spark, sf_dir, "silver")
    roles = CL.Roles(txn_id=None, txn_date=None)
    lt = CL.label_transactions(d["br_transactions"], d["sl_players"], roles, [])
    return lt.where(F.col("_rule").isNull()).select("id", "player_id")


@query("cl_drop_before_approval")
def _cl08(spark, sf_dir):
    """Before-approval rule alone, approval date = sl_players.kyc_approved_at."""
    d = D(spark, sf_dir, "silver")
    roles = CL.Roles(txn_id=None, ply_kyc_bool=None, ply_kyc_date="kyc_approved_at")
    lt = CL.label_transactions(d["br_transactions"], d["sl_players"], roles, [])
    return lt.where(F.col("_rule").isNull()).select("id", "player_id", "timestamp")


@query("clean_domain")
def _cl09(spark, sf_dir):
    """Whole cleaning job with the reference's roles; surviving transactions."""
    a, p, t = _raw(spark, sf_dir)
    return CL.clean_domain(a, p, t, CL.Roles(), CLEAN_ORDER).transactions


@query("clean_audit")
def _cl10(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    return CL.clean_domain(a, p, t, CL.Roles(), CLEAN_ORDER).audit


# ---------------------------------------------------------------- history snapshot (§2.11)
from strata.operators import snapshot as SN  # noqa: E402

SNAPSHOT_CUT = "1998-01-01 00:00:00"


def _latest_players(br: DataFrame, before: str | None = None) -> DataFrame:
    if before is not None:
        br = br.where(F.col("updated_at") < F.lit(before).cast("timestamp_ntz"))
    latest = WN.deduplicate(br, "id", [F.col("updated_at").desc_nulls_last(), F.col("created_at").desc_nulls_last()],
                            binding.driver_tie_break())
    return latest.drop("version_id")


@query("players_snapshot_initial")
def _sn02(spark, sf_dir):
    br = D(spark, sf_dir, "bronze")["br_players"]
    return SN.snapshot_initial(_latest_players(br))


@query("players_snapshot_merge")
def _sn01(spark, sf_dir):
    """History of versions before the cut, merged with the latest versions."""
    br = D(spark, sf_dir, "bronze")["br_players"]
    history = SN.snapshot_initial(_latest_players(br, SNAPSHOT_CUT))
    return SN.snapshot_merge(history, _latest_players(br))


# ---------------------------------------------------------------- sources and sinks (§2.1), pipeline (§2.13)
import uuid  # noqa: E402

from strata.plans.pipeline import run_medallion  # noqa: E402
from strata.session import scratch_path  # noqa: E402
from strata.sources import io as IO  # noqa: E402


def _scratch(spark, name):
    return f"{scratch_path(spark, name)}-{uuid.uuid4().hex[:8]}"


@query("src_csv_scan")
def _src01(spark, sf_dir):
    """raw players → CSV → typed read back → bronze."""
    raw = D(spark, sf_dir, "raw")["raw_players"]
    path = IO.write_raw_csv(raw, _scratch(spark, "players.csv"))
    back = IO.read_raw_csv(spark, path, raw.columns)
    return L.br_players(back)


@query("src_csv_line_breaks")
def _src01_records(spark, sf_dir):
    """documents (texts with line breaks and quotes) → CSV → read by splits."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    path = IO.write_raw_csv(docs, _scratch(spark, "documents.csv"), multi_line=True)
    return read_csv_records(spark, path)


@query("src_csv_dir")
def _src02(spark, sf_dir):
    d = D(spark, sf_dir, "raw")
    src, dst = _scratch(spark, "csv-in"), _scratch(spark, "landing")
    for n in ("affiliates", "players", "transactions"):
        IO.write_raw_csv(d[f"raw_{n}"], f"{src}/{n}.csv")
    landed = IO.ingest_dir(spark, src, dst)
    parts = [spark.read.parquet(uri).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(stem).alias("table_name"), "row_count") for stem, uri in landed.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("src_drop_unnamed")
def _src03(spark, sf_dir):
    raw = D(spark, sf_dir, "raw")["raw_affiliates"]
    with_index = raw.select(F.col("id").alias("Unnamed: 0"), "*", F.lit(None).cast("string").alias("unnamed_7"))
    return IO.drop_unnamed(with_index)


@query("src_csv_to_parquet")
def _src04(spark, sf_dir):
    raw = D(spark, sf_dir, "raw")["raw_transactions"]
    csv = IO.write_raw_csv(raw, _scratch(spark, "transactions.csv"))
    return spark.read.parquet(IO.csv_to_parquet(spark, csv, _scratch(spark, "transactions.parquet")))


def _load_twice(spark, sf_dir, mode):
    raw = D(spark, sf_dir, "raw")["raw_transactions"]
    uri = _scratch(spark, "raw_transactions.parquet")
    raw.write.parquet(uri)
    loc = _scratch(spark, "tbl_transactions")
    name = f"raw_transactions_{mode}_{uuid.uuid4().hex[:6]}"
    IO.load_table(spark, uri, name, location=loc, mode="overwrite", count=False)
    IO.load_table(spark, uri, name, location=loc, mode=mode, count=False)
    return spark.table(name).agg(F.count(F.lit(1)).alias("row_count")) \
        .select(F.lit("raw_transactions").alias("table_name"), "row_count")


@query("src_load_truncate")
def _src06(spark, sf_dir):
    return _load_twice(spark, sf_dir, "overwrite")


@query("src_load_append")
def _src07(spark, sf_dir):
    return _load_twice(spark, sf_dir, "append")


@query("snk_csv")
def _snk09(spark, sf_dir):
    a, p, t = _raw(spark, sf_dir)
    cleaned = CL.clean_domain(a, p, t, CL.Roles(), CLEAN_ORDER).transactions
    path = IO.write_csv(cleaned, _scratch(spark, "transactions_clean.csv"))
    return IO.read_raw_csv(spark, path, cleaned.columns)


@query("snk_table")
def _snk10(spark, sf_dir):
    p = D(spark, sf_dir, "silver")["sl_players"]
    return spark.read.parquet(IO.write_table(p, _scratch(spark, "sl_players")))


@query("snk_view")
def _snk11(spark, sf_dir):
    g = D(spark, sf_dir, "gold")["g_player_daily_balance"]
    return IO.as_view(g, "g_player_daily_balance")


@query("snk_partitioned")
def _snk12(spark, sf_dir):
    t = D(spark, sf_dir, "silver")["sl_transactions"]
    path = IO.write_table(t, _scratch(spark, "sl_transactions"), partition_by_day="txn_timestamp")
    return spark.read.parquet(path)


@query("run_medallion")
def _pl01(spark, sf_dir):
    """Whole pipeline from a CSV folder of the bound raw tables; rows per written table."""
    d = D(spark, sf_dir, "raw")
    src = _scratch(spark, "medallion-src")
    for n in ("affiliates", "players", "transactions"):
        IO.write_raw_csv(d[f"raw_{n}"], f"{src}/{n}.csv")
    return run_medallion(spark, src, _scratch(spark, "medallion-out"), checks="warn",
                         amount_type=binding.DRIVER_AMOUNT, player_keep=("version_id",),
                         tie_break=[F.col("version_id").cast("bigint").desc()])


# ---------------------------------------------------------------- table extension (§2.12)
from strata.operators import extend as EX  # noqa: E402

EX_SEED, EX_NOW = 42, "2025-09-01 00:00:00"


def _ex_input(spark, sf_dir):
    """The cleaned domain (clean_domain), typed by the bronze models."""
    a, p, t = _raw(spark, sf_dir)
    res = CL.clean_domain(a, p, t, CL.Roles(), CLEAN_ORDER, once=IO.materialize)
    return (L.br_affiliates(res.affiliates), L.br_players(res.players),
            L.br_transactions(res.transactions, binding.DRIVER_AMOUNT))


def _ext(spark, sf_dir, keep_code=False):
    a, p, t = _ex_input(spark, sf_dir)
    ext = EX.extend_domain(a, p, t, seed=EX_SEED, now=EX_NOW, keep_code=keep_code)
    return ext, ext.inputs


@query("ex_new_ids")
def _ex01(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return ext.affiliates.select("id")


@query("ex_random_code")
def _ex02(spark, sf_dir):
    ext, (a, _p, _t) = _ext(spark, sf_dir)
    mx = a.agg(F.max("id")).first()[0]
    return ext.affiliates.where(F.col("id") > mx).select("id", "code")


@query("ex_choice_from_pool")
def _ex03(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return ext.affiliates.select("id", "origin").unionAll(
        ext.players.select("id", F.col("country_code").alias("origin")))


@query("ex_weighted_bool")
def _ex04(spark, sf_dir):
    ext, (_a, p, _t) = _ext(spark, sf_dir)
    mx = p.agg(F.max("id")).first()[0]
    return ext.players.where(F.col("id") > mx).select("id", "is_kyc_approved")


@query("ex_choice_from_table")
def _ex05(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir, keep_code=True)
    return ext.players.select("id", "affiliate_code_redeemed")


@query("ex_created_approved_dates")
def _ex06(spark, sf_dir):
    ext, (_a, p, _t) = _ext(spark, sf_dir)
    mx = p.agg(F.max("id")).first()[0]
    new = ext.players.where(F.col("id") > mx).select("id", "is_kyc_approved")
    return EX.created_approved_dates(new, EX_SEED, EX_NOW, approved="kyc_verified_at")


@query("ex_redeemed_at")
def _ex07(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return ext.affiliates.select("id", "redeemed_at")


@query("ex_affiliate_id_from_code")
def _ex08(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return ext.players.select("id", "affiliate_id")


@query("ex_updated_at")
def _ex09(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return ext.players.select("id", "created_at", "updated_at")


@query("ex_transactions")
def _ex10(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return ext.transactions


@query("extend_domain")
def _ex11(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return AG.row_counts({"affiliates": ext.affiliates, "players": ext.players, "transactions": ext.transactions})


@query("ex_validation")
def _ex11b(spark, sf_dir):
    ext, _ = _ext(spark, sf_dir)
    return EX.validate_extension(ext, ext.new_counts["target"])


def _ext_roles(spark, sf_dir):
    """The extension with an owner of each affiliate and an approval date of each player:
    three days after registration for the approved players of the input."""
    a, p, t = _ex_input(spark, sf_dir)
    a = a.withColumn("owner_player_id", F.lit(None).cast("bigint"))
    p = p.withColumn("kyc_verified_at", F.when(F.col("is_kyc_approved"), fn.offset(F.col("created_at"), 3, 0)))
    return EX.extend_domain(a, p, t, seed=EX_SEED, now=EX_NOW, owner="owner_player_id", approved="kyc_verified_at")


@query("ex_owner")
def _ex05b(spark, sf_dir):
    return _ext_roles(spark, sf_dir).affiliates.select("id", "owner_player_id")


@query("ex_approval_dates")
def _ex06b(spark, sf_dir):
    return _ext_roles(spark, sf_dir).players.select("id", "kyc_verified_at")


@query("ex_transactions_after_approval")
def _ex10b(spark, sf_dir):
    return _ext_roles(spark, sf_dir).transactions


@query("ex_validation_dates")
def _ex11c(spark, sf_dir):
    """Input transactions before their player's approval date are the violations."""
    ext = _ext_roles(spark, sf_dir)
    return EX.validate_extension(ext, ext.new_counts["target"], "kyc_verified_at").where(
        "check_name = 'kyc_left_audit'")


@query("dq_code_consistent")
def _dq11(spark, sf_dir):
    """Players whose redeemed code disagrees with their affiliate's code (extended domain)."""
    ext, _ = _ext(spark, sf_dir, keep_code=True)
    return DQ.code_consistent(ext.players, ext.affiliates).select("id", "affiliate_id", "affiliate_code_redeemed")
