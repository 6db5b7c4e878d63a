"""The stored history: change-only runs, merge on read, compaction, older states, concurrent writers."""

from __future__ import annotations

import datetime as dt
import glob
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import snapshot as SN
from strata.sources.commits import CommitLog, ConcurrentCommit
from strata.sources.history import History

DAY = [dt.datetime(2024, 1, d) for d in range(1, 9)]
VERSION = "id long, v string, updated_at timestamp_ntz"


def _base(scratch):
    return f"{scratch}/hist-{uuid.uuid4().hex[:8]}"


def _rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def _stamps(base):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/data/**/*.parquet", recursive=True)}


RUNS = [[(1, "a", DAY[0]), (2, "x", DAY[0]), (None, "n", DAY[0]), (5, "u", None)],
        [(1, "b", DAY[1]), (None, "n", DAY[0])],
        [(1, "c", DAY[2]), (3, "z", DAY[2]), (None, "m", DAY[1]), (None, "m", DAY[1])],
        [(2, "y", DAY[3]), (3, "z", DAY[2]), (5, "w", DAY[1])]]


@pytest.mark.parametrize("compact_after", [(), (1,), (0, 2), (0, 1, 2, 3)])
def test_history_equals_merged_snapshots(spark, scratch, compact_after):
    base, expect = _base(scratch), None
    h = History(spark, base)
    assert h.read() is None and h.version() == 0
    states, written = {}, {}
    for i, rows in enumerate(RUNS):
        cur = spark.createDataFrame(rows, VERSION)
        h.apply(cur)
        expect = SN.snapshot_merge(expect, cur)
        if i in compact_after:
            h.compact(buckets=4)
        assert written.items() <= _stamps(base).items()       # nothing written before is touched
        written = _stamps(base)
        assert _rows(h.read()) == _rows(expect)
        assert _rows(h.read(open_only=True)) == _rows(expect.where("dbt_valid_to IS NULL"))
        states[h.version()] = _rows(expect)
    for at, want in states.items():                           # every older state can still be read
        assert _rows(h.read(at=at)) == want
    before = h.version()
    assert h.apply(spark.createDataFrame(RUNS[-1], VERSION)) == before   # no change, no version


def test_second_run_writes_its_changes_only(spark, scratch):
    h, n = History(spark, _base(scratch)), 20_000
    cur = spark.range(n).select("id", F.lit("a").alias("v"), F.lit(DAY[0]).cast("timestamp_ntz").alias("updated_at"))
    h.apply(cur)
    hit = F.col("id") % 100 == 0
    nxt = cur.withColumn("v", F.when(hit, "b").otherwise(F.col("v"))).withColumn("updated_at", F.when(hit, F.lit(DAY[1])).otherwise(F.col("updated_at")).cast("timestamp_ntz"))
    at = h.apply(nxt)
    entry = h.log.read(at)
    assert (entry["open_rows"], entry["closed_rows"]) == (n // 100, n // 100)
    assert spark.read.parquet(entry["open"], entry["closed"]).count() == 2 * n // 100
    assert h.read(open_only=True).count() == n and h.read().count() == n + n // 100
    # compaction rewrites the touched buckets alone
    h.compact(buckets=16)
    before = h.log.last()[1]["open"]
    h.apply(spark.createDataFrame([(7, "z", DAY[5])], VERSION))
    h.compact(buckets=16)
    after = h.log.last()[1]["open"]
    assert sum(before[b] != after[b] for b in after) == 1 and len(after) == 16
    assert h.read(open_only=True).where("id = 7").first().v == "z" and h.read().count() == n + n // 100 + 1
    h.apply(spark.createDataFrame([(8, "y", DAY[5])], VERSION))
    h.compact(buckets=3)                                      # another bucket count writes all anew
    assert sorted(h.log.last()[1]["open"]) == ["0", "1", "2"] and h.read(open_only=True).count() == n


def test_current_is_evaluated_once(spark, scratch):
    marker = F.concat(F.col("v"), F.lit("once-only"))
    old = SN.snapshot_initial(spark.createDataFrame(RUNS[0], VERSION))
    cur = spark.createDataFrame(RUNS[1], VERSION).withColumn("v", marker)
    for df in (SN.snapshot_delta(old, cur), SN.snapshot_merge(old, cur)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Distinct") + plan.count("Aggregate") == 2     # one for each side's rows, not one a branch
        assert "Union" not in plan
    # dealt once by the identity: the join adds no exchange to the side of the new rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parquet = f"{scratch}/cur-{uuid.uuid4().hex[:6]}"
        cur.write.parquet(parquet)
        SN.snapshot_initial(spark.createDataFrame(RUNS[0], VERSION)).write.parquet(parquet + "-old")
        df = SN.snapshot_delta(spark.read.parquet(parquet + "-old"), spark.read.parquet(parquet))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_writers(spark, scratch):
    """Writers that start from one state: both sets of changes end up in the history, once each."""
    base = _base(scratch)
    History(spark, base).apply(spark.createDataFrame([(i, "a", DAY[0]) for i in range(10)], VERSION))
    feeds = [[(1, "left", DAY[1]), (20, "l", DAY[1])], [(2, "right", DAY[1]), (1, "later", DAY[2])]]
    errors = []

    def write(rows):
        try:
            History(spark, base).apply(spark.createDataFrame(rows, VERSION))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(f,)) for f in feeds]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    h = History(spark, base)
    assert h.version() == 3
    opened = {r.id: r.v for r in h.read(open_only=True).collect()}
    assert len(opened) == 11 and opened[1] == "later" and opened[2] == "right" and opened[20] == "l"
    assert h.read().groupBy("id").agg(F.count_if(F.col("dbt_valid_to").isNull()).alias("n")).where("n != 1").count() == 0


def test_lost_run_leaves_the_history(spark, scratch):
    h = History(spark, _base(scratch))
    h.apply(spark.createDataFrame(RUNS[0], VERSION))
    want = _rows(h.read())
    bad = spark.createDataFrame([(1, "b", DAY[1])], VERSION).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        h.apply(bad)
    assert h.version() == 1 and _rows(h.read()) == want


def test_commit_log(spark, scratch):
    log = CommitLog(spark, _base(scratch))
    assert log.last() == (0, None) and log.entries() == []
    log.commit(1, {"a": "é"})
    with pytest.raises(ConcurrentCommit):
        log.commit(1, {"a": 2})
    log.commit(2, {"b": []})
    assert log.entries() == [(1, {"a": "é"}), (2, {"b": []})] and log.last() == (2, {"b": []})
    won = []

    def race(i):
        try:
            log.commit(3, {"by": i})
            won.append(i)
        except ConcurrentCommit:
            pass

    threads = [threading.Thread(target=race, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and log.read(3) == {"by": won[0]}
