"""Hot keys: one player holding a third of all transactions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import dedup as WN
from strata.operators.joins import MAX_HOT, gate, hot_keys, key_counts, spread
from strata.plans import layers as L

N = 30000


@pytest.fixture(scope="module")
def hot(spark):
    base = dt.datetime(2024, 1, 1)
    txn = spark.range(N).select(
        F.col("id"),
        (F.lit(base) + F.make_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500 + 100).alias("player_id"),
        F.when(F.col("id") % 2 == 0, F.lit("deposit")).otherwise(F.lit("withdraw")).alias("type"),
        (F.col("id") % 997).cast("decimal(18,2)").alias("amount"))
    players = spark.range(0, 700).select(
        F.col("id"), F.lit(True).alias("is_kyc_approved"),
        F.when(F.col("id") == 7, F.lit(dt.datetime(2024, 1, 3))).otherwise(F.lit(base))
         .cast("timestamp_ntz").alias("kyc_approved_at"))
    return txn, players


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_salted_gate_equals_unsalted(hot):
    txn, players = hot
    salted = gate(txn, players, salt=4)
    plain = gate(txn, players, salt=1)
    assert _rows(salted) == _rows(plain)
    assert salted.where("player_id = 7").count() == plain.where("player_id = 7").count() > N // 4


def test_hot_player_topn_and_balance(spark, hot):
    txn, players = hot
    t = L.sl_transactions(txn, players.withColumn("id", F.col("id")))
    top = L.top_player_deposits(t)
    plan = top._jdf.queryExecution().executedPlan().toString()
    # the per-player top-n is limited map-side before the player-keyed exchange
    assert "WindowGroupLimit" in plan and "Partial" in plan
    hot_top = [r.top_deposit_amount for r in top.where("player_id = 7").orderBy("rank_position").collect()]
    assert len(hot_top) == 3 and hot_top == sorted(hot_top, reverse=True)
    bal = L.player_daily_balance(t)
    bplan = bal._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in bplan
    total = bal.agg(F.sum("deposits")).first()[0]
    assert total == t.where("type = 'deposit'").agg(F.sum("amount")).first()[0]


def test_left_join_spreads_null_keys(spark):
    from strata.operators.joins import NULL_KEY_BUCKETS, left_join
    left = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50)
                                    .cast("bigint").alias("fk"))
    right = spark.range(40).select(F.col("id").alias("pk"), (F.col("id") * 10).alias("v"))
    got = left_join(left, right, "fk", "pk")
    want = left.join(right, left.fk == right.pk, "left")
    assert _rows(got.select("id", "fk", "pk", "v")) == _rows(want.select("id", "fk", "pk", "v"))
    # the join is keyed on (fk, bucket): NULL-key rows hash to many partitions instead of one
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_nbl" in plan and "_nbr" in plan
    assert NULL_KEY_BUCKETS > 1


def test_salt_is_computed_once(hot):
    """The salt is non-nullable: no inferred ``isnotnull`` re-evaluates it below the projection."""
    txn, players = hot
    plan = gate(txn, players, salt=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("xxhash64") == 1


# --- hot keys by measurement: rows of the largest task, AQE (and so its skew join) off

@pytest.fixture()
def plain_joins(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(old, ("false", "-1", "64")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _largest(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


BOUND = 500


@pytest.mark.parametrize("equal_rows", [False, True])
def test_hot_key_join_back_is_bounded(spark, plain_joins, equal_rows):
    df = spark.range(0, N, 1, 40).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1500 + 100).alias("k"),
                                         (F.lit(1) if equal_rows else F.col("id")).cast("bigint").alias("v"))
    want = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    unbounded = WN.count_over(df, "k", "v", "n", hot_rows=10 ** 9)
    assert _largest(unbounded) >= N // 3                              # what measurement is for
    for out in (WN.count_over(df, "k", "v", "n", hot_rows=BOUND), WN.mark_duplicates(df, "k", hot_rows=BOUND)):
        assert _largest(out) <= 5 * BOUND
        assert out.count() == N
    counted = WN.count_over(df, "k", "v", "n", hot_rows=BOUND)
    assert {r.k: (r.n, r.c) for r in counted.groupBy("k").agg(F.max("n").alias("n"), F.count("*").alias("c")).collect()} == {k: (n, n) for k, n in want.items()}
    assert _rows(counted) == _rows(unbounded)
    if not equal_rows:
        kept, removed = WN.keep_first(df, "k", "v", hot_rows=BOUND)
        assert _largest(removed) <= 5 * BOUND
        kept0, removed0 = WN.keep_first(df, "k", "v", hot_rows=10 ** 9)
        assert _rows(kept) == _rows(kept0) and _rows(removed) == _rows(removed0)


def test_hot_affiliate_bridge_is_bounded(spark, plain_joins):
    a = spark.range(300).select("id", F.lit("c").alias("code"), F.lit("x").alias("origin"), F.lit(None).cast("timestamp_ntz").alias("redeemed_at"))
    p = spark.range(0, N, 1, 40).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 200).cast("bigint").alias("affiliate_id"))
    bridge, plain = L.sl_affiliate_player_bridge(a, p, hot_rows=BOUND), L.sl_affiliate_player_bridge(a, p, hot_rows=10 ** 9)
    assert _largest(plain) >= N // 3 and _largest(bridge) <= 5 * BOUND
    assert _rows(bridge) == _rows(plain)


def test_measured_gate_is_bounded(hot, plain_joins):
    txn, players = hot
    txn = txn.repartition(40, "id")
    out = gate(txn, players, counts=key_counts(txn, "player_id"), bound=BOUND)
    assert _rows(out) == _rows(gate(txn, players, salt=1))
    assert _largest(gate(txn, players)) > 4000 and _largest(out) <= 5 * BOUND
    # ordinary players are not repeated
    right = spread(txn, players.withColumnRenamed("id", "_gk"), hot_keys(key_counts(txn, "player_id"), ["player_id"], "rows", BOUND), ["player_id"], ["_gk"])[1]
    copies = {r._gk: r["count"] for r in right.groupBy("_gk").count().collect()}
    assert copies.pop(7) == N // 3 // BOUND and set(copies.values()) == {1}


def test_hot_keys_are_bounded_in_number(spark):
    per_key = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") + 1000).alias("rows"))
    got = hot_keys(per_key, ["k"], "rows", 100).collect()
    assert len(got) <= MAX_HOT and min(r._copies for r in got) >= (1000 + 10_000 - MAX_HOT) // 100
