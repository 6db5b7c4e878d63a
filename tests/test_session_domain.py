"""Session helpers and the lazy bound domain."""

from __future__ import annotations

import pytest

from strata.session import checkpoint_dir, run_concurrently


def test_run_concurrently_keeps_order_and_raises(spark):
    out = run_concurrently([lambda i=i: spark.range(i * 10).count() for i in range(4)])
    assert out == [0, 10, 20, 30]

    def boom():
        raise ValueError("x")
    with pytest.raises(ValueError):
        run_concurrently([lambda: spark.range(3).count(), boom])


def test_checkpoint_dir_is_set(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()


def test_domain_is_lazy_and_memoised(spark):
    from conftest import SF0001
    from strata.plans import binding
    d = binding.domain(spark, SF0001, "silver")
    assert "g_player_daily_balance" not in d and "sl_transactions" in d
    assert d["sl_players"] is d["sl_players"]
    assert len(d._built) == 3                      # sl_players, br_players, raw_players only
    assert set(d._built) == {"sl_players", "br_players", "raw_players"}


def test_domain_materialize_silver(spark):
    from conftest import SF0001
    from strata.plans import binding
    d = binding.domain(spark, SF0001, "gold", materialize="silver")
    # silver tables are scans of written files, built before any consumer asks
    assert {"sl_players", "sl_affiliates", "sl_transactions", "sl_affiliate_player_bridge"} <= set(d._built)
    plan = d["sl_players"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "parquet" in plan.lower() and "Window" not in plan
    assert d["g_player_daily_balance"].count() == 225
