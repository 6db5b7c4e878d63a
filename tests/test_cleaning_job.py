"""Cleaning job: the shipped golden pair (FIXTURES.md §2a), rule audit, single rules."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans.cleaning_job import Roles, clean_domain

ORDER = {k: ["_input_order"] for k in ("affiliates", "players", "transactions")}
ID_ORDER = {k: ["id"] for k in ORDER}


@pytest.fixture(scope="module")
def cleaned(sample_raw):
    r = sample_raw
    return clean_domain(r["affiliates"], r["players"], r["transactions"], order_cols=ORDER)


def test_golden_affiliates_unchanged(cleaned):
    a = cleaned.affiliates.orderBy(F.col("id").cast("int")).collect()
    assert [r.id for r in a] == [str(i) for i in range(1, 11)]
    assert a[0].code == "DWEHSP" and a[3].origin is None


def test_golden_players_keep_first_row_of_id10(cleaned):
    p = cleaned.players.collect()
    assert len(p) == 10
    p10 = [r for r in p if r.id == "10"]
    assert len(p10) == 1 and p10[0].is_kyc_approved is False
    # only role columns are parsed: other dates keep their text, as in the shipped output
    assert p10[0].updated_at == "2024-11-04 11:19:33+00:00"
    assert set(cleaned.players.columns) == {"id", "affiliate_id", "country_code", "is_kyc_approved",
                                            "created_at", "updated_at", "_input_order"}


def test_golden_transactions_parsed_date(cleaned):
    t = {r.id: r.timestamp for r in cleaned.transactions.collect()}
    assert t["1"] == dt.datetime(2024, 1, 10, 17, 7, 1)
    assert "_rule" not in cleaned.transactions.columns


def test_golden_transactions(cleaned):
    ids = sorted(int(r.id) for r in cleaned.transactions.collect())
    assert ids == [1, 2, 3, 5, 7, 8, 9]


def test_audit(cleaned):
    audit = {(r.rule, r.table_name): r.rows_affected for r in cleaned.audit.collect()}
    assert audit[("unique_ids", "players")] == 1
    assert audit[("drop_not_approved", "transactions")] == 3
    assert audit[("orphan_txn", "transactions")] == 0
    assert audit[("unique_ids", "transactions")] == 0
    assert audit[("unique_codes", "affiliates")] == 0
    # the reference's actual columns have no approval-date role: the rule does not run
    assert ("drop_before_approval", "transactions") not in audit


def test_before_approval_rule_with_date_role(spark):
    """NULL approval date keeps the row; an earlier transaction is dropped."""
    a = spark.createDataFrame([("1", "C1")], "id string, code string")
    p = spark.createDataFrame([("1", "true", "2024-02-01 00:00:00"), ("2", "yes", None)],
                              "id string, is_kyc_approved string, approved string")
    t = spark.createDataFrame([("1", "2024-01-15 00:00:00", "1"), ("2", "2024-03-01 00:00:00", "1"),
                               ("3", "2020-01-01 00:00:00", "2"), ("4", "2024-03-01 00:00:00", "9")],
                              "id string, timestamp string, player_id string")
    roles = Roles(ply_kyc_date="approved")
    cr = clean_domain(a, p, t, roles, ID_ORDER)
    assert sorted(r.id for r in cr.transactions.collect()) == ["2", "3"]
    audit = {(r.rule, r.table_name): r.rows_affected for r in cr.audit.collect()}
    assert audit[("drop_before_approval", "transactions")] == 1
    assert audit[("orphan_txn", "transactions")] == 1


def test_owner_and_code_rules(spark):
    a = spark.createDataFrame([("1", "AAA", "1"), ("2", "BBB", "99"), ("3", "CCC", None), ("4", "AAA", "1")],
                              "id string, code string, owner string")
    # codes compare exactly (case-sensitive): "aaa" is unknown
    p = spark.createDataFrame([("1", "TRUE", "AAA"), ("2", "TRUE", "zzz"), ("3", "TRUE", "aaa")],
                              "id string, is_kyc_approved string, redeemed string")
    t = spark.createDataFrame([("1", "2024-01-01 00:00:00", "1")], "id string, timestamp string, player_id string")
    roles = Roles(aff_owner="owner", ply_redeemed_code="redeemed")
    cr = clean_domain(a, p, t, roles, ID_ORDER)
    assert sorted(r.id for r in cr.affiliates.collect()) == ["1"]
    codes = {r.id: r.redeemed for r in cr.players.collect()}
    assert codes == {"1": "AAA", "2": None, "3": None}
    audit = {(r.rule, r.table_name): r.rows_affected for r in cr.audit.collect()}
    assert audit[("unique_codes", "affiliates")] == 1
    assert audit[("drop_bad_owner", "affiliates")] == 2
    assert audit[("null_unknown_codes", "players")] == 2


def test_duplicate_ids_and_rule_order(spark):
    """One row per id whatever the order, of identical rows too; a code known only from an
    affiliate that lacks its owner stays with the player; a missing order is an error."""
    a = spark.createDataFrame([("1", "AAA", "1"), ("1", "BBB", "1"), ("2", "CCC", "99"), ("3", "DDD", "2"), ("3", "DDD", "2")],
                              "id string, code string, owner string")
    p = spark.createDataFrame([("1", "TRUE", "CCC"), ("2", "TRUE", "BBB")], "id string, is_kyc_approved string, redeemed string")
    t = spark.createDataFrame([("1", "2024-01-01 00:00:00", "1")], "id string, timestamp string, player_id string")
    roles = Roles(aff_owner="owner", ply_redeemed_code="redeemed")
    cr = clean_domain(a, p, t, roles, ID_ORDER)
    assert sorted((r.id, r.code) for r in cr.affiliates.collect()) == [("1", "AAA"), ("3", "DDD")]
    assert {r.id: r.redeemed for r in cr.players.collect()} == {"1": "CCC", "2": None}
    audit = {(r.rule, r.table_name): r.rows_affected for r in cr.audit.collect()}
    assert audit[("unique_ids", "affiliates")] == 2 and audit[("null_unknown_codes", "players")] == 1
    with pytest.raises(ValueError):
        clean_domain(a, p, t, roles, {"players": ["id"]})


def test_driver_counts(spark):
    """Not-approved rule alone against sl_players drops 3,713 rows at sf0.001 (FIXTURES §3)."""
    import __spark_entry__ as E
    from conftest import SF0001
    df = E.queries()["cl_drop_not_approved"](spark, SF0001)
    kept = df.count()
    assert kept == 6000 - 3713
