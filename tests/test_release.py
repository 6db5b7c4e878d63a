"""Releases: a failed run leaves the old tables, a rerun goes on where it stopped, counts and hashes come from the writes."""

from __future__ import annotations

import glob
import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import content_metrics
from strata.plans import layers as L
from strata.plans import pipeline as P
from strata.sources.release import Release


def _files(out, *layers):
    return {f: os.stat(f).st_mtime_ns for layer in layers for f in glob.glob(f"{out}/{layer}/**/*.parquet", recursive=True)}


@pytest.fixture()
def src(sample_dir, scratch):
    path = os.path.join(scratch, f"src-{uuid.uuid4().hex[:8]}")
    shutil.copytree(sample_dir, path)
    return path


def test_failed_run_keeps_the_release_and_is_resumed(spark, src, scratch, monkeypatch):
    out = os.path.join(scratch, f"rel-{uuid.uuid4().hex[:8]}")
    first = sorted(map(tuple, P.run_medallion(spark, src, out).collect()))
    release = Release(spark, out)
    old = sorted(map(str, release.read("silver/sl_players").collect()))
    with open(f"{src}/players.csv", "a") as f:
        f.write("11,1,NL,TRUE,2024-10-11 00:00:00+00:00,2024-10-12 00:00:00+00:00\n")

    def lost(*a):
        raise RuntimeError("lost in silver")

    with monkeypatch.context() as m:
        m.setattr(L, "sl_affiliate_player_bridge", lost)
        with pytest.raises(RuntimeError, match="lost in silver"):
            P.run_medallion(spark, src, out)
    # the tables of the first run are what readers get
    assert release.log.last()[0] == 1
    assert sorted(map(str, release.read("silver/sl_players").collect())) == old
    assert release.read("bronze/br_players").where("id = 11").count() == 0
    before, snapshots = _files(out, "landing", "bronze", "checks/bronze", "silver"), _files(out, "snapshots")
    done = [r.row_count for r in P.run_medallion(spark, src, out).collect() if r.table_name == "br_players"]
    # landing, bronze, its checks, the snapshot and the silver dimensions were not written again
    after = _files(out, "landing", "bronze", "checks/bronze")
    assert after == {f: t for f, t in before.items() if "/silver/" not in f}
    assert {f for f in _files(out, "silver") if "/sl_players/" in f} == {f for f in before if "/sl_players/" in f}
    assert _files(out, "snapshots") == snapshots
    assert done == [12] and release.log.last()[0] == 2
    assert release.read("silver/sl_players").where("id = 11").count() == 1
    assert sorted(map(str, release.read("silver/sl_players", at=1).collect())) == old      # and the old release still reads
    # without a change a new run is a new release with the same content
    again = P.run_medallion(spark, src, out)
    assert sorted(map(tuple, again.collect())) != first and release.log.last()[0] == 3
    assert {k: (v["rows"], v["hash"]) for k, v in release.tables(3).items() if "hash" in v} == \
        {k: (v["rows"], v["hash"]) for k, v in release.tables(2).items() if "hash" in v}
    gone = release.vacuum(keep=1)
    assert gone and all(os.path.exists(t["path"]) for t in release.tables().values())
    assert not os.path.exists(release.tables(1)["silver/sl_players"]["path"])


def test_resume_needs_equal_inputs(spark, src, scratch, monkeypatch):
    out = os.path.join(scratch, f"rel-{uuid.uuid4().hex[:8]}")
    with monkeypatch.context() as m:
        m.setattr(L, "gold", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            P.run_medallion(spark, src, out)
    release = Release(spark, out)
    with pytest.raises(FileNotFoundError):
        release.tables()
    run_id = os.listdir(f"{out}/_runs")[0]
    assert release.begin("another input").id != run_id
    with open(f"{src}/players.csv", "a") as f:
        f.write("11,1,NL,TRUE,2024-10-11 00:00:00+00:00,2024-10-12 00:00:00+00:00\n")
    counts = {r.table_name: r.row_count for r in P.run_medallion(spark, src, out).collect()}
    assert counts["br_players"] == 12 and release.entry()["run"] != run_id


def test_counts_and_hashes_are_those_of_the_tables(spark, src, scratch):
    out = os.path.join(scratch, f"rel-{uuid.uuid4().hex[:8]}")
    rows = P.run_medallion(spark, src, out).collect()
    release = Release(spark, out)
    for r in rows:
        if r.layer != "snapshot":
            t = release.read(f"{r.layer}/{r.table_name}")
            got = t.agg(*content_metrics(t)).first()
            assert (got.row_count, got.content_hash) == (r.row_count, r.content_hash), r


def test_content_hash(spark):
    df = spark.createDataFrame([(1, "a", True), (2, None, False), (2, "", None)], "id long, v string, b boolean")
    of = lambda d: tuple(d.agg(*content_metrics(d)).first())
    assert of(df) == of(df.repartition(3).orderBy(F.desc("v")).select("b", "v", "id"))
    assert of(df)[1] != of(df.withColumn("v", F.coalesce("v", F.lit(""))))[1]       # NULL is not ''
    assert of(df.union(df.limit(1)))[1] != of(df)[1] and of(df.limit(0)) == (0, "0")


def test_two_runs_at_once_release_one_after_the_other(spark, scratch):
    release = Release(spark, os.path.join(scratch, f"rel-{uuid.uuid4().hex[:8]}"))
    a = release.begin("in")
    b = release.begin("in", resume=False)
    same = release.begin("in")                       # a second process resumes the newest: steps are entered once
    assert same.id == b.id and a.id != b.id
    assert b.record("x", {"by": 1}) == {"by": 1} and same.done("x") == {"by": 1}
    assert b.publish({}) == 1 and same.publish({}) == 1 and a.publish({}) == 2
    assert release.begin("in").id not in (a.id, b.id)
