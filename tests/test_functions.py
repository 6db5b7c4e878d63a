"""Scalar functions on literal edge rows (NULL, '', padding, '-', '1-2', '1.0', ...)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import cleaning as fn


def one_col(spark, values, fn_, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn_(F.col("v"))).collect()]


def test_clean_string(spark):
    vals = ["  Hello \t  World\n", None, "", "A\r\nB", "x y ", "\u000bpad\u000b"]
    assert one_col(spark, vals, fn.clean_string) == ["hello world", None, "", "a b", "x y", "\u000bpad\u000b"]
    assert one_col(spark, vals, lambda c: fn.clean_string(c, to_lower=False))[0] == "Hello World"


def test_clean_string_non_text(spark):
    assert one_col(spark, [12], fn.clean_string, "int") == ["12"]


def test_country_iso2(spark):
    assert one_col(spark, [" de ", "DEU", "br", None, "", "  "], fn.normalize_country_iso2) == \
        ["DE", None, "BR", None, None, None]


def test_parse_timestamp_safe(spark):
    got = one_col(spark, ["2024-01-10 17:07:01+00:00", "2024-01-10 19:07:01+02:00", "", None, "garbage"],
                  fn.parse_timestamp_safe)
    t = dt.datetime(2024, 1, 10, 17, 7, 1)
    assert got == [t, t, None, None, None]


def test_parse_timestamp_strict_raises(spark):
    with pytest.raises(Exception):
        one_col(spark, ["garbage"], lambda c: fn.parse_timestamp_safe(c, strict=True))


def test_parse_bool_safe(spark):
    vals = ["TRUE", "t", "Yes", "1", "FALSE", "f", "no", "0", " true", "", None, "maybe"]
    assert one_col(spark, vals, fn.parse_bool_safe) == \
        [True, True, True, True, False, False, False, False, None, None, None, None]


def test_coerce_bool_trims_and_has_no_t_f(spark):
    vals = [" true ", "Y", "1", "No", "t", "f", None]
    assert one_col(spark, vals, fn.coerce_bool) == [True, True, True, False, None, None, None]


def test_parse_numeric_safe(spark):
    vals = ["$1,234.50", "-12.5", "-", "1-2", "", None, "abc", "7"]
    got = one_col(spark, vals, fn.parse_numeric_safe)
    assert got == [Decimal("1234.5"), Decimal("-12.5"), None, None, None, None, None, Decimal("7")]


def test_parse_numeric_type(spark):
    df = spark.range(1).select(fn.parse_numeric_safe(F.lit("1.5")).alias("x"))
    assert df.schema["x"].dataType.simpleString() == "decimal(38,9)"


def test_to_int64(spark):
    assert one_col(spark, ["1", "1.0", "1.7", " 3 ", "x", None, ""], fn.to_int64) == [1, 1, 2, 3, None, None, None]


def test_txn_sign_keeps_scale(spark):
    df = spark.createDataFrame([("Deposit", "5.25"), ("withdraw", "5.25"), ("bet", "1")], "t string, a string")
    out = df.select(fn.normalize_txn_sign("t", fn.parse_numeric_safe("a")).alias("s"))
    assert out.schema["s"].dataType.simpleString() == "decimal(38,9)"
    assert [r.s for r in out.collect()] == [Decimal("5.25"), Decimal("-5.25"), None]


def test_conditional_amounts(spark):
    df = spark.createDataFrame([("deposit", 5), ("WITHDRAW", 3), ("win", 9)], "t string, a int")
    d, w = fn.conditional_amounts("t", "a")
    assert [tuple(r) for r in df.select(d, w).collect()] == [(5, 0), (0, -3), (0, 0)]


def test_kyc_filter_and_approved_at(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = spark.createDataFrame([(True, t2, t1), (True, t1, t2), (None, t2, t1), (False, t2, t1), (True, t2, None)],
                               "f boolean, ts timestamp_ntz, at timestamp_ntz")
    assert [r[0] for r in df.select(fn.kyc_txn_filter("ts", "f", "at")).collect()] == [True, False, None, False, None]
    df2 = spark.createDataFrame([(True, None, t1), (True, t2, t1), (False, t2, t1)],
                                "f boolean, u timestamp_ntz, c timestamp_ntz")
    assert [r[0] for r in df2.select(fn.approved_at("f", "u", "c")).collect()] == [t1, t2, None]


def test_blank_to_null_and_normalize_code(spark):
    df = spark.createDataFrame([(" ab ", "  "), (None, "x"), ("", "\t")], "a string, b string")
    out = fn.blank_to_null(df, ["b", "missing"]).select(fn.normalize_code("a").alias("a"), "b").collect()
    assert [tuple(r) for r in out] == [("AB", None), (None, "x"), (None, None)]


def test_is_not_true_first_non_null_offset(spark):
    assert one_col(spark, [True, False, None], fn.is_not_true, "boolean") == [False, True, True]
    df = spark.createDataFrame([(None, 2, 3), (None, None, 3), (1, 2, 3)], "a int, b int, c int")
    assert [r[0] for r in df.select(fn.first_non_null("a", "b", "c")).collect()] == [2, 3, 1]
    t = dt.datetime(2024, 1, 31, 23, 0)
    df = spark.createDataFrame([(t,)], "t timestamp_ntz")
    assert df.select(fn.offset("t", days=1, minutes=90)).first()[0] == dt.datetime(2024, 2, 2, 0, 30)


def test_txn_day_is_utc_day(spark):
    df = spark.range(1).select(fn.txn_day(fn.parse_timestamp_safe(F.lit("2024-03-01 23:30:00-02:00"))).alias("d"))
    assert df.first().d == dt.date(2024, 3, 2)


def test_strict_parsers_raise(spark):
    for f in (lambda c: fn.parse_numeric_safe(c, strict=True), lambda c: fn.to_int64(c, strict=True)):
        with pytest.raises(Exception):
            one_col(spark, ["-"], f)
    assert one_col(spark, ["$12.50"], lambda c: fn.parse_numeric_safe(c, strict=True)) == [Decimal("12.5")]
    assert one_col(spark, ["1.0"], lambda c: fn.to_int64(c, strict=True)) == [1]


def test_text_without_a_date_is_no_timestamp(spark):
    vals = ["12:30:00", "T1", "2024-01-10 17:07:01+00:00", "2024-01-10", "x", None]
    want = [None, None, dt.datetime(2024, 1, 10, 17, 7, 1), dt.datetime(2024, 1, 10), None, None]
    assert one_col(spark, vals, fn.parse_timestamp_safe) == want
    assert one_col(spark, vals, fn.parse_datetime_utc) == want


def test_country_code_strips_any_white_space(spark):
    assert one_col(spark, ["\tBR", "br\n", " b r", "BRA"], fn.normalize_country_iso2) == ["BR", "BR", None, None]


FORMATS = {"03/02/2024": "M/d/yyyy", "13/02/2024": "d/M/yyyy", "3-2-2024 7:05": "M-d-yyyy H:mm", "31.12.2023": "d.M.yyyy",
           "2024/02/03 07:05:09": "yyyy/M/d H:mm:ss", "20240203": "yyyyMMdd", "Feb 3, 2024": "MMM d, yyyy", "February 3, 2024": "MMMM d, yyyy",
           "3 Feb 2024": "d MMM yyyy", " 3 March 2024 7:05 pm ": "d MMMM yyyy h:mm a", "2024-02-03": fn.ISO, "soon": fn.ISO, "": fn.ISO, None: fn.ISO}


def test_guess_datetime_format():
    assert {v: fn.guess_datetime_format(v) for v in FORMATS} == FORMATS


def test_first_value_fixes_the_format(spark):
    rows = [(3, "2024-02-05", "5 Feb 2024", None), (1, None, " ", ""), (2, " 02/03/2024 ", "3 Feb 2024 07:05:09", " "),
            (4, "14/03/2024", "4 feb 2024 7:05:10", None), (5, "2/4/2024", "2024-02-04", None), (6, "02/30/2024", "x", None)]
    df = spark.createDataFrame(rows, "pos int, a string, b string, c string").repartition(4)
    formats = fn.infer_datetime_formats(df, ["a", "b", "c"], ["pos"])
    assert formats == {"a": "M/d/yyyy", "b": "d MMM yyyy H:mm:ss", "c": fn.ISO}
    got = {r.pos: (r.a, r.b, r.c) for r in df.select("pos", *[fn.parse_datetime_utc(c, f).alias(c) for c, f in formats.items()]).collect()}
    day = dt.datetime
    assert got == {1: (None, None, None), 2: (day(2024, 2, 3), day(2024, 2, 3, 7, 5, 9), None), 3: (None, None, None),
                   4: (None, day(2024, 2, 4, 7, 5, 10), None), 5: (day(2024, 2, 4), None, None), 6: (None, None, None)}
    assert fn.infer_datetime_formats(df.limit(0), ["a"], ["pos"]) == {"a": fn.ISO}


def test_cleaning_job_infers_dates(spark):
    from strata.plans.cleaning_job import Roles, clean_domain
    a = spark.createDataFrame([("1", "AAA")], "id string, code string")
    p = spark.createDataFrame([("1", "yes", "13.01.2024")], "id string, is_kyc_approved string, approved string")
    t = spark.createDataFrame([("1", "1", "14/01/2024 10:00"), ("2", "1", "2/1/2024 9:30"), ("3", "1", "2024-01-20")], "id string, player_id string, timestamp string")
    order = {k: ["id"] for k in ("affiliates", "players", "transactions")}
    res = clean_domain(a, p, t, Roles(ply_kyc_date="approved"), order, infer_dates=True)
    assert [(r.id, r.timestamp) for r in res.transactions.orderBy("id").collect()] == [("1", dt.datetime(2024, 1, 14, 10)), ("3", None)]
    audit = {r.rule: r.rows_affected for r in res.audit.collect()}
    assert audit["drop_before_approval"] == 1
