"""Driver contract: entry(), queries() × oracle_sql() agree with DuckDB on sf0.001."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF0001

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["player_id", "txn_date", "deposits", "withdrawals"]
    assert df.count() == 225


def test_every_library_query_has_an_oracle():
    from strata.plans import registry
    assert set(registry.QUERIES) <= set(ORACLES) <= set(QUERIES)


def test_no_forbidden_calls_in_the_package():
    import pathlib

    import strata
    for path in pathlib.Path(strata.__file__).parent.rglob("*.py"):
        src = path.read_text()
        assert not any(x in src for x in ("localCheckpoint", ".sample(", "crossJoin", ".rdd")), path


@pytest.fixture(scope="module")
def duck():
    from tools.check_oracles import connect
    return connect(SF0001)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    from tools.check_oracles import compare_one
    status, msg, _n = compare_one(spark, duck, QUERIES, ORACLES, key, SF0001)
    assert status == "OK", msg
