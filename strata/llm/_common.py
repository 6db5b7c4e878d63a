"""Helpers shared by the operators: reading, written intermediate tables, word
hashes over Arrow batches, range buckets, and connected components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

WHITESPACE = r"\x20\x09-\x0D"
#: Text bytes that one vectorised step works on; bounds a Python worker's memory.
SLICE_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, keeps column pruning."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the folders behind a table written by ``write_table`` that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def free_name(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores in front as make it none of ``taken`` (in any case of letters)."""
    return name if name.lower() not in {c.lower() for c in taken} else free_name("_" + name, taken)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_buckets(df: DataFrame, key: str, n: int) -> list[int]:
    """At most ``n`` - 1 ascending integer bounds that cut ``key`` into ranges of about
    equal row counts (one pass over the key column; the result is bounded by n)."""
    if n < 2:
        return []
    cuts = df.select(key).approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n)
    return sorted({int(c) for c in cuts})


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """Index of the range holding ``key``: the number of bounds <= key (binary search by width_bucket on an array)."""
    if not bounds:
        return F.lit(0)
    return F.expr(f"CAST(width_bucket({key._jc.toString()}, array({','.join(map(str, bounds))})) AS INT)")


# --- words -----------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def splitmix(n: int, seed: int) -> np.ndarray:
    """The first ``n`` numbers of a splitmix64 stream."""
    with np.errstate(over="ignore"):
        return _mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = splitmix(256, 7)
_BYTE_LOWER = _BYTE[_LOWER]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """Words (runs without ASCII white space) of a slice of texts.

    ``start``/``end`` are byte offsets into ``data``; ``first[i]:first[i+1]`` are the
    words of text i; ``hash`` is one 64-bit hash per word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~IS_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        self.start = np.flatnonzero(word & (~before | edge[:n]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        length = self.end - self.start
        if len(length):
            where = np.flatnonzero(word)
            place = np.arange(len(where)) - np.repeat(np.cumsum(length) - length, length)
            with np.errstate(over="ignore"):
                terms = (_BYTE_LOWER if lower else _BYTE)[data[where]] * splitmix(int(length.max()), 99)[place]
                total = np.add.reduceat(terms, np.cumsum(length) - length)
                self.hash = _mix(total + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        else:
            self.hash = np.zeros(0, np.uint64)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words inside a text, and their bounds by text
        (repeats included).  A text with fewer words has its whole sequence as one."""
        out, bounds = [], [0]
        run = ngram_hash(self.hash, k)
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= k:
                out.append(run[a:b - k + 1])
            elif b > a:
                out.append(ngram_hash(self.hash[a:b], b - a))
            bounds.append(bounds[-1] + (len(out[-1]) if b > a else 0))
        return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array(bounds)


def ngram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (length len(h) - k + 1)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        mult = splitmix(k, 1000 + k) | np.uint64(1)
        total = np.full(n, np.uint64(k), np.uint64)
        for j in range(k):
            total += h[j:j + n] * mult[j]
        return _mix(total)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column (null: empty) into runs of rows of about ``limit`` bytes:
    (first row, last row + 1, bytes, byte offsets).  One text is never cut."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    _, at, buf = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + limit, side="right")) - 1)
        yield a, b, data[at[a]:at[b]], at[a:b + 1] - at[a]
        a = b


# --- connected components --------------------------------------------------------------

def _stars(e: DataFrame) -> bool:
    """Whether every component of the edges (a > b) is a star around its smallest id."""
    ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                      F.struct(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("r"))
    odd = ends.groupBy("r.x").agg(F.sum("r.up").alias("up"), F.max("r.down").alias("down")).filter("up > 1 OR up = 1 AND down = 1")
    return odd.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (columns a, b), the component being the
    smallest id reachable.  Alternating large-star and small-star rounds, each one
    written to the shared folder; no row is collected."""
    e = write_table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "edges")
    while not _stars(e):
        both = e.union(e.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", F.explode(F.array(F.struct(F.col("v").alias("a"), "m"), F.struct(F.col("u").alias("a"), "m"))).alias("x"))
        new = write_table(small.select("x.a", F.col("x.m").alias("b")).filter("a <> b").distinct(), "edges")
        drop_table(e)
        e = new
    top = e.select(F.col("b").alias("id")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(top.select("id", "id"))
