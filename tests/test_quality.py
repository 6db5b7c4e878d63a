"""Data-quality checks: each fires on the binding views (FIXTURES.md §3 counts) and passes on clean rows."""

from __future__ import annotations

import datetime as dt

import pytest

from strata.operators import quality as DQ


@pytest.fixture(scope="module")
def d(spark):
    from conftest import SF0001
    from strata.plans import binding
    return binding.domain(spark, SF0001)


def test_unique_fires(d):
    assert DQ.unique(d["br_players"], "id").count() == 150
    assert DQ.unique(d["sl_transactions"], "id").count() == 11
    assert DQ.unique(d["sl_players"], "id").count() == 0


def test_values_in_ci(d):
    assert DQ.values_in_ci(d["sl_transactions"], "type", ["Deposit", "Withdraw"]).count() == 69
    trimmed = d["br_transactions"]  # bronze already trims and lower-cases
    assert DQ.values_in_ci(trimmed, "type", ["deposit", "withdraw"]).count() == 2070


def test_values_in_ci_null_passes(spark):
    df = spark.createDataFrame([("DEPOSIT",), (None,), ("bet",)], "type string")
    assert [r.type for r in DQ.values_in_ci(df, "type", ["deposit"]).collect()] == ["bet"]


def test_functional_dependency(d):
    assert DQ.functional_dependency(d["br_players"], "id", "is_kyc_approved").count() == 150
    assert DQ.functional_dependency(d["br_players"], "id", "created_at").count() == 0


def test_functional_dependency_counts_null_combos(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", "x"), (2, None, None), (2, None, None)],
                               "k int, a string, b string")
    assert [r.k for r in DQ.functional_dependency(df, "k", ["a", "b"]).collect()] == [1]


def test_one_to_one(d):
    v = DQ.one_to_one(d["sl_affiliate_player_bridge"], "affiliate_id", "player_id")
    assert v.count() == 4


def test_no_txn_before_kyc(d):
    assert DQ.no_txn_before_kyc(d["sl_transactions"], d["sl_players"]).count() == 0
    raw_fail = DQ.no_txn_before_kyc(d["br_transactions"], d["sl_players"], "timestamp")
    assert raw_fail.count() > 0


def test_unique_by_key(d):
    assert DQ.unique_by_key(d["g_player_daily_balance"], ["player_id", "txn_date"]).count() == 0
    assert DQ.unique_by_key(d["br_transactions"], "id").count() == 1161


def test_ref_integrity_skips_null(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "id int")
    assert [r.fk for r in DQ.ref_integrity(child, "fk", parent, "id").collect()] == [99]


def test_ref_integrity_dangling(d):
    assert DQ.ref_integrity(d["sl_players"], "affiliate_id", d["sl_affiliates"], "id").count() == 25


def test_txn_signs(spark):
    df = spark.createDataFrame([("deposit", -1.0), ("deposit", 1.0), ("Withdraw", 2.0), ("withdraw", -2.0)],
                               "type string, amount double")
    assert DQ.txn_signs_consistent(df).count() == 2


def test_code_consistent_and_left_audit(spark):
    a = spark.createDataFrame([(1, "ABC"), (2, "XYZ")], "id long, code string")
    p = spark.createDataFrame([(1, 1, " abc "), (2, 2, "abc"), (3, None, "abc"), (4, 9, "q")],
                              "id long, affiliate_id long, affiliate_code_redeemed string")
    assert sorted(r.id for r in DQ.code_consistent(p, a).collect()) == [2, 4]
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    players = spark.createDataFrame([(1, True, t1)], "id long, is_kyc_approved boolean, kyc_approved_at timestamp_ntz")
    txn = spark.createDataFrame([(1, 1, t2), (2, 1, dt.datetime(2023, 1, 1)), (3, 7, t2)],
                                "id long, player_id long, ts timestamp_ntz")
    assert sorted(r.id for r in DQ.no_txn_before_kyc(txn, players, "ts").collect()) == [2]
    assert sorted(r.id for r in DQ.no_txn_before_kyc(txn, players, "ts", unknown_is_violation=True).collect()) == [2, 3]


def test_min_rows(spark):
    df = spark.range(5)
    assert DQ.min_rows(df, 5).count() == 0
    assert DQ.min_rows(df, 6).first().row_count == 5


def test_report(d):
    rep = {(r.table_name, r.check_name, r.columns): (r.violations, r.status) for r in DQ.dq_report(d).collect()}
    assert rep[("br_players", "unique", "id")] == (150, "warn")
    assert rep[("sl_players", "unique", "id")] == (0, "pass")
    assert rep[("sl_transactions", "no_txn_before_kyc", "txn_timestamp")] == (0, "pass")
    assert rep[("sl_affiliate_player_bridge", "one_to_one", "affiliate_id,player_id")] == (4, "warn")
    assert rep[("g_player_daily_balance", "unique_by_key", "player_id,txn_date")] == (0, "pass")
    assert rep[("sl_players", "ref_integrity_nullable", "affiliate_id")] == (25, "warn")
    # every row-level count equals the standalone check
    assert rep[("sl_players", "not_null", "country_code")][0] == DQ.not_null(d["sl_players"], "country_code").count()


def test_report_severity_error(d):
    c = DQ.Check("silver", "br_players", "unique", ("id",), severity="error")
    r = DQ.dq_report(d, [c]).first()
    assert (r.violations, r.status) == (150, "fail")


def test_dependency_by_extremes_counts_as_distinct_combinations(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, 1), (2, "x", 1), (3, None, None), (3, None, None), (4, "a", 1), (4, "a", 2),
            (5, "a", 1), (None, "a", 1), (None, "b", 1)]
    df = spark.createDataFrame(rows, "k int, a string, b int")
    check = DQ.Check("x", "t", "functional_dependency", ("k",), {"dependents": ("a", "b")})
    report = DQ.dq_report({"t": df}, [check])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert [r.violations for r in report.collect()] == [DQ.functional_dependency(df, "k", ["a", "b"]).count()] == [3]
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_one_to_one_takes_one_exchange_a_side(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (2, 3), (4, 3), (5, None), (None, 6)], "l int, r int")
    v = DQ.one_to_one(df, "l", "r")
    assert v._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert sorted(r.l for r in v.collect()) == [2, 3]
