"""The stored type-2 history as a log of changes (SN-01).

A run writes its new versions and the versions that it closes, nothing else; untouched versions stay where they
were written.  Readers merge: open versions are those of the last compaction and of the runs since, without the
ones that a later run closed (an anti join with the few closings); closed versions are never written again.
``compact`` rewrites the open versions by hash bucket of the key, only the buckets that runs have touched since.

Every run and compaction is one entry of the commit log, so a lost job leaves the history as it was, two writers cannot
destroy each other (the second computes its changes again from the new state), and a reader can ask for an older state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import snapshot as SN
from strata.sources.commits import CommitLog, ConcurrentCommit, delete, folders

BUCKETS = 64


class History:
    def __init__(self, spark: SparkSession, base: str, key: str = "id", updated_at: str = "updated_at"):
        self.spark, self.base, self.key, self.updated_at = spark, base.rstrip("/"), key, updated_at
        self.log = CommitLog(spark, self.base)

    def version(self) -> int:
        return max([0, *self.log.numbers()])

    # --- reading
    def _state(self, at: int | None) -> dict:
        """Folders behind version ``at``: open by bucket, closed, and those of the runs since the last compaction."""
        state = {"open": {}, "closed": [], "runs": [], "buckets": None}
        for n, e in self.log.entries():
            if at is not None and n > at:
                break
            if e["kind"] == "compaction":
                state = {"open": e["open"], "closed": e["closed"], "runs": [], "buckets": e["buckets"]}
            else:
                state["runs"].append(e)
        return state

    def _scan(self, paths: list[str]) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def _without_closed(self, opened: DataFrame | None, runs: list[dict]) -> DataFrame | None:
        closings = self._scan([e["closed"] for e in runs if e["closed"]])
        if opened is None or closings is None:
            return opened
        # a version is its key and update time; rows without a key or a time are never closed
        gone = closings.select(F.col(self.key).alias("_k"), F.col("dbt_updated_at").alias("_u"))
        return opened.join(gone, (F.col(self.key) == F.col("_k")) & (F.col("dbt_updated_at") == F.col("_u")), "left_anti")

    def read(self, open_only: bool = False, at: int | None = None) -> DataFrame | None:
        """All versions (or the open ones) as of commit ``at`` (default: the newest); None before the first."""
        state = self._state(at)
        opened = self._without_closed(self._scan([*state["open"].values(), *[e["open"] for e in state["runs"] if e["open"]]]), state["runs"])
        closed = None if open_only else self._scan([*state["closed"], *[e["closed"] for e in state["runs"] if e["closed"]]])
        if opened is None or closed is None:
            return opened if closed is None else closed
        return opened.unionByName(closed, allowMissingColumns=True)

    # --- writing
    def apply(self, current: DataFrame, attempts: int = 5) -> int:
        """Add the changes that ``current`` (unique by key) makes; returns the version that holds them.  A run without
        changes adds no version."""
        for _ in range(attempts):
            at = self.version()
            opened = self.read(open_only=True, at=at)
            changes = SN.snapshot_delta(opened, current, self.key, self.updated_at)
            folder, seen = f"{self.base}/data/{uuid.uuid4().hex}", Observation()
            is_open = F.col("dbt_valid_to").isNull()
            (changes.withColumn("run_state", F.when(is_open, F.lit("open")).otherwise(F.lit("closed")))
             .observe(seen, F.count_if(is_open).alias("open_rows"), F.count_if(~is_open).alias("closed_rows"))
             .write.mode("errorifexists").partitionBy("run_state").parquet(folder))
            rows = {k: int(v or 0) for k, v in seen.get.items()}
            written = folders(self.spark, folder)
            if not any(rows.values()):
                delete(self.spark, folder)
                return at
            there = lambda s: f"{folder}/run_state={s}" if f"run_state={s}" in written else None
            try:
                return self.log.commit(at + 1, {"kind": "run", "open": there("open"), "closed": there("closed"), **rows})
            except ConcurrentCommit:
                delete(self.spark, folder)
        raise ConcurrentCommit(f"{self.base}: {attempts} attempts met other writers")

    def _bucket(self, buckets: int) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(F.col(f"`{self.key}`")), F.lit(buckets)), F.lit(0)).cast("int")

    def compact(self, buckets: int = BUCKETS) -> int:
        """Rewrite the open versions of the hash buckets that runs have touched since the last compaction (all buckets the
        first time); other buckets and all closed versions stay where they are.  Readers of older versions are not disturbed."""
        at = self.version()
        state = self._state(at)
        if not state["runs"]:
            return at
        old = state["open"] if state["buckets"] in (None, buckets) else {}
        if state["buckets"] not in (None, buckets):  # another bucket count: everything is written anew
            touched = list(range(buckets))
        else:
            news = self._scan([p for e in state["runs"] for p in (e["open"], e["closed"]) if p])
            touched = sorted(r[0] for r in news.select(self._bucket(buckets)).distinct().collect())  # at most ``buckets`` numbers
        paths = [p for b, p in state["open"].items() if not old or int(b) in touched]
        opened = self._without_closed(self._scan([*paths, *[e["open"] for e in state["runs"] if e["open"]]]), state["runs"])
        folder, kept = f"{self.base}/data/{uuid.uuid4().hex}", {b: p for b, p in old.items() if int(b) not in touched}
        if opened is not None:
            (opened.withColumn("bucket", self._bucket(buckets)).hint("rebalance", "bucket")
             .write.mode("errorifexists").partitionBy("bucket").parquet(folder))
            kept |= {name[7:]: f"{folder}/{name}" for name in folders(self.spark, folder) if name.startswith("bucket=")}
        closed = [*state["closed"], *[e["closed"] for e in state["runs"] if e["closed"]]]
        return self.log.commit(at + 1, {"kind": "compaction", "open": kept, "closed": closed, "buckets": buckets})
