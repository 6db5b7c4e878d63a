"""A numbered commit log in a folder: what stands in it is what readers see.

Data goes to new folders first; an entry that names them then appears whole or not at all, and
only one writer can create entry ``n``.  Two writers that started from the same state thus
never overwrite each other: the second gets ``ConcurrentCommit`` and starts again from the new state.

The entry is written under another name and put in place by a hard link on a local file system, by a
rename that refuses an existing target elsewhere (atomic on HDFS; an object store needs a
file-system layer with such a rename).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentCommit(RuntimeError):
    """Another writer committed this number."""


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (none when it does not exist): metadata only."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


class CommitLog:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.folder = spark, f"{base.rstrip('/')}/_log"

    def numbers(self) -> list[int]:
        fs, p = file_system(self.spark, self.folder)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, n: int) -> dict:
        fs, p = file_system(self.spark, f"{self.folder}/{n:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def entries(self) -> list[tuple[int, dict]]:
        """All entries in order; one small file each."""
        return [(n, self.read(n)) for n in self.numbers()]

    def last(self) -> tuple[int, dict | None]:
        """The newest entry and its number (0 and None without one)."""
        n = self.numbers()
        return (n[-1], self.read(n[-1])) if n else (0, None)

    def commit(self, n: int, entry: dict) -> int:
        """Create entry ``n``, or raise ``ConcurrentCommit`` where it exists."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        fs, final = file_system(self.spark, f"{self.folder}/{n:012d}.json")
        _, new = file_system(self.spark, f"{self.folder}/.{n:012d}-{uuid.uuid4().hex}")
        stream = fs.create(new, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        try:
            if fs.makeQualified(new).toUri().getScheme() == "file":
                local = lambda p: jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(local(final), local(new))
            else:
                no_options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(new).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                context.rename(fs.makeQualified(new), fs.makeQualified(final), no_options)
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            raise ConcurrentCommit(f"{self.folder}: entry {n} exists") from None
        finally:
            fs.delete(new, False)
        return n
