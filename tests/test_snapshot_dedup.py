"""History snapshot invariants and the row-selection operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import dedup as WN
from strata.operators import snapshot as SN

T = [dt.datetime(2024, 1, d) for d in range(1, 8)]
SCHEMA = "id long, v string, updated_at timestamp_ntz"


def test_snapshot_merge_rules(spark):
    cur0 = spark.createDataFrame([(1, "a", T[0]), (2, "b", T[0]), (3, "c", T[0])], SCHEMA)
    h0 = SN.snapshot_merge(None, cur0)
    assert h0.where(F.col("dbt_valid_to").isNull()).count() == 3
    # 1 updated, 2 unchanged, 3 absent, 4 new
    cur1 = spark.createDataFrame([(1, "a2", T[2]), (2, "b", T[0]), (4, "d", T[3])], SCHEMA)
    h1 = SN.snapshot_merge(h0, cur1)
    rows = sorted((r.id, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in h1.collect())
    assert rows == [(1, "a", T[0], T[2]), (1, "a2", T[2], None), (2, "b", T[0], None),
                    (3, "c", T[0], None), (4, "d", T[3], None)]


def test_snapshot_idempotent_and_consistent(spark):
    cur0 = spark.createDataFrame([(i, "x", T[0]) for i in range(20)], SCHEMA)
    cur1 = spark.createDataFrame([(i, "y", T[1 + i % 3]) for i in range(0, 30, 2)], SCHEMA)
    h = SN.snapshot_merge(SN.snapshot_merge(None, cur0), cur1)
    h_again = SN.snapshot_merge(h, cur1)
    key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert key(h) == key(h_again)
    # at most one open version per key, no overlapping intervals
    assert h.where("dbt_valid_to is null").groupBy("id").count().where("count > 1").count() == 0
    w = Window.partitionBy("id").orderBy("dbt_valid_from")
    nxt = h.withColumn("nxt", F.lead("dbt_valid_from").over(w))
    assert nxt.where("nxt is not null and (dbt_valid_to is null or dbt_valid_to > nxt)").count() == 0
    assert h.select("dbt_scd_id").distinct().count() == h.count()


def test_snapshot_driver_merge(spark):
    import __spark_entry__ as E
    from conftest import SF0001
    df = E.queries()["players_snapshot_merge"](spark, SF0001)
    assert df.where("dbt_valid_to is null").groupBy("id").count().where("count > 1").count() == 0
    assert df.where("dbt_valid_to is null").count() == 150


def test_deduplicate_with_tie_break(spark):
    df = spark.createDataFrame([(1, T[1], 5), (1, T[1], 7), (1, T[0], 9), (2, None, 1), (2, T[0], 2)],
                               "id long, u timestamp_ntz, ver long")
    out = WN.deduplicate(df, "id", [F.col("u").desc_nulls_last()], [F.col("ver").desc()])
    assert sorted((r.id, r.ver) for r in out.collect()) == [(1, 7), (2, 2)]


def test_top_n(spark):
    df = spark.createDataFrame([(1, v) for v in (5, 9, 1, 7)] + [(2, 3)], "k long, a long")
    out = WN.top_n(df, "k", [F.col("a").desc()], 3, "rank_position")
    assert sorted((r.k, r.a, r.rank_position) for r in out.collect()) == [(1, 5, 3), (1, 7, 2), (1, 9, 1), (2, 3, 1)]


def test_keep_first_and_removed(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (None, 4, "n1"), (None, 5, "n2")],
                               "k long, pos long, v string")
    kept, removed = WN.keep_first(df, "k", "pos")
    assert sorted(r.v for r in kept.collect()) == ["a", "b", "n1"]
    assert sorted(r.v for r in removed.collect()) == ["c", "n2"]


def test_count_over_and_mark_duplicates(spark):
    df = spark.createDataFrame([(1, 10), (1, None), (2, 20), (None, 30), (None, 40)], "g long, v long")
    c = sorted(((r.g, r.v, r.n) for r in WN.count_over(df, "g", "v", "n").collect() if r.g is not None), key=str)
    assert c == sorted([(1, 10, 1), (1, None, 1), (2, 20, 1)], key=str)
    nulls = [r.n for r in WN.count_over(df, "g", "v", "n").collect() if r.g is None]
    assert nulls == [2, 2]
    m = {r.v: r.is_duplicate for r in WN.mark_duplicates(df, "g").collect()}
    assert m == {10: True, None: True, 20: False, 30: True, 40: True}


def test_hot_key_dedup_stays_partial(spark):
    """A key holding a third of all rows: the plan limits map-side (partial WindowGroupLimit)."""
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("v"))
    out = WN.deduplicate(df, "k", [F.col("v").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.count() == n - n // 3 + 1
    assert out.where("k = 0").first().v == n - 3


def test_first_per_key_matches_keep_first(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (None, 4, "n1"), (None, 5, "n2"), (3, 9, None)],
                               "k long, pos long, v string")
    kept, removed = WN.keep_first(df, "k", "pos")
    first = WN.first_per_key(df, "k", "pos", "dups")
    assert first.columns == ["k", "pos", "v", "dups"]
    assert sorted(map(str, first.drop("dups").collect())) == sorted(map(str, kept.collect()))
    assert first.agg(F.sum("dups")).first()[0] == removed.count() == 2


def test_first_per_key_hot_key_is_partial(spark):
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("pos"))
    first = WN.first_per_key(df, "k", "pos", "dups")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    hot = first.where("k = 0").first()
    assert (hot.pos, hot.dups) == (0, n // 3 - 1)
