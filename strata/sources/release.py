"""Releases of a set of tables: every run writes new folders, and one commit makes them what readers see.

A run keeps a progress log of its finished steps.  When it is lost, the released tables stand as before, and the next run
over the same inputs goes on at the first step without an entry instead of writing again what is written.  A finished run
is released by one entry of the manifest that names all of its folders; until then, and after any failure,
readers get the release before.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.sources.commits import CommitLog, ConcurrentCommit, delete, file_system, folders


class Run:
    """One run in progress: ``done`` and ``record`` its steps, then ``publish``."""

    def __init__(self, release: Release, run_id: str, signature: str):
        self.release, self.id, self.signature = release, run_id, signature
        self.log = CommitLog(release.spark, f"{release.out}/_runs/{run_id}")
        self.resumed = [e["step"] for _, e in self.log.entries()][1:]

    def folder(self, name: str) -> str:
        """A folder for this attempt at table ``name``; a lost attempt never meets another's files."""
        return f"{self.release.out}/{name}/{self.id}-{uuid.uuid4().hex[:8]}"

    def done(self, step: str) -> dict | None:
        return next((e["result"] for _, e in self.log.entries() if e["step"] == step), None)

    def record(self, step: str, result: dict) -> dict:
        """Enter a finished step.  Where another process has entered it meanwhile, its result counts."""
        while True:
            n = max([0, *self.log.numbers()]) + 1
            try:
                self.log.commit(n, {"step": step, "result": result})
                return result
            except ConcurrentCommit:
                if (other := self.done(step)) is not None:
                    return other

    def publish(self, tables: dict[str, dict], **more) -> int:
        """Release ``tables`` (name to {path, columns, ...}); one commit swaps all of them."""
        while True:
            n, newest = self.release.log.last()
            if newest is not None and newest["run"] == self.id:
                return n
            try:
                return self.release.log.commit(n + 1, {"run": self.id, "tables": tables, **more})
            except ConcurrentCommit:
                continue  # another run was released in between: this one goes after it


class Release:
    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.log = CommitLog(spark, f"{self.out}/_manifest")

    def begin(self, signature: str, resume: bool = True) -> Run:
        """A new run, or the newest unreleased one over the same inputs and arguments."""
        released = {e["run"] for _, e in self.log.entries()}
        for run_id in reversed(folders(self.spark, f"{self.out}/_runs")) if resume else []:
            if run_id not in released:
                entries = CommitLog(self.spark, f"{self.out}/_runs/{run_id}").entries()
                if entries and entries[0][1]["result"].get("signature") == signature:
                    return Run(self, run_id, signature)
        started = len(folders(self.spark, f"{self.out}/_runs"))
        run = Run(self, f"{started:06d}-{uuid.uuid4().hex[:8]}", signature)
        run.record("begin", {"signature": signature})
        return run

    def entry(self, at: int | None = None) -> dict:
        n, newest = self.log.last()
        if newest is None:
            raise FileNotFoundError(f"{self.out} has no release")
        return newest if at is None or at == n else self.log.read(at)

    def tables(self, at: int | None = None) -> dict[str, dict]:
        return self.entry(at)["tables"]

    def read(self, name: str, at: int | None = None) -> DataFrame:
        """Table ``name`` of the newest release (or release ``at``)."""
        return self.open(self.tables(at)[name])

    def open(self, table: dict) -> DataFrame:
        return self.spark.read.parquet(table["path"]).select(*[f"`{c}`" for c in table["columns"]])

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders of runs before the last ``keep`` releases and their progress logs.  Runs that started after the
        oldest kept release stay, finished or not."""
        entries = self.log.entries()[-keep:]
        if not entries:
            return []
        used = {t["path"].rstrip("/").rsplit("/", 1)[-1] for _, e in entries for t in e["tables"].values()}
        oldest = min(e["run"] for _, e in entries)
        gone = []
        for run_id in (r for r in folders(self.spark, f"{self.out}/_runs") if r < oldest):
            for layer in folders(self.spark, self.out):
                for name in [] if layer.startswith("_") else folders(self.spark, f"{self.out}/{layer}"):
                    for attempt in folders(self.spark, f"{self.out}/{layer}/{name}"):
                        if attempt.startswith(run_id) and attempt not in used:
                            gone.append(f"{self.out}/{layer}/{name}/{attempt}")
            gone.append(f"{self.out}/_runs/{run_id}")
        for path in gone:
            delete(self.spark, path)
        return gone


def signature_of(spark: SparkSession, folder: str, *arguments: object) -> str:
    """Digest of names, sizes and times of the files in ``folder`` and of the arguments: what a resumed run must have in common."""
    fs, p = file_system(spark, folder)
    files, todo = [], [p]
    while todo:
        for s in fs.listStatus(todo.pop()):
            if s.isDirectory():
                todo.append(s.getPath())
            else:
                files.append(f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}")
    return hashlib.sha256("|".join([*sorted(files), *map(str, arguments)]).encode()).hexdigest()
