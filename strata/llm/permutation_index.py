"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``LIST`` nearest pivots in order (pivots are rows of the table,
chosen by a hash).  The index holds every row: rows are dealt by a hash into shards of about
``SHARD`` rows, and a shard keeps one inverted file per pivot with (row, position of the pivot in
that row's order).  A query visits the lists of its own pivots in every shard and adds up the
footrule distance, the sum of |position there - position here| over its pivots, a pivot that
is missing in a row standing at position ``LIST``.  The closest share of a shard by footrule is
ranked again by the inner product of the original vectors in double precision, and the best
of all shards are merged.

The share is fitted: the smallest one at which sampled queries find ``recall`` of their true
neighbours in a sample of at most ``SAMPLE`` rows.  Nothing else depends on the sample, and
every row is indexed and may be found.  Because rows are dealt by a hash, equal or nearly equal
vectors spread evenly over the shards; a task holds one shard and streams queries past it.

Defined cases: rows without vec_id, and vectors that are null, empty, zero or hold null or
non-finite components, take no part; rows that share vec_id are one row with the least of
their vectors; vectors of different lengths are no candidates of each other; equal scores go
to the smaller vec_id; with fewer candidates than wanted all are returned; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import write_table

PIVOTS = 1024
#: Pivots in a row's ordered representation (a one-byte position).
LIST = 64
#: Rows of a shard, about; bounds the memory of a task.
SHARD = 8192
#: Rows and queries of the sample that fits the share.
SAMPLE, SAMPLE_QUERIES = 20_000, 200
SHARES = (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8, 1.0)
#: Rows of a shard that are ranked again in any case, as a multiple of the wanted neighbours.
LEAST = 4


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>), dim: one row per vec_id with a usable vector."""
    good = (F.col("vec_id").isNotNull() & (F.coalesce(F.size("embedding"), F.lit(0)) > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.coalesce(good, F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min("embedding").cast("array<double>").alias("embedding")).withColumn("dim", F.size("embedding"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, dim)


class Pivots:
    """Unit pivots of one length and the orders they give."""

    def __init__(self, points: np.ndarray):
        self.unit = points / np.linalg.norm(points, axis=1, keepdims=True)
        self.length = min(LIST, len(points))

    def order(self, x: np.ndarray) -> np.ndarray:
        """The nearest pivots of every row, nearest first (equal ones by their number)."""
        near = -((x / np.linalg.norm(x, axis=1, keepdims=True)) @ self.unit.T)
        return np.argsort(near, axis=1, kind="stable")[:, :self.length].astype(np.int16)


class Shard:
    """Rows of one shard and their pivot inverted files."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, order: np.ndarray, pivots: int):
        rank = np.argsort(ids, kind="stable")  # equal footrules and scores go to the smaller id
        self.ids, self.x, order = ids[rank], x[rank], order[rank]
        self.length = order.shape[1]
        flat = order.ravel()
        post = np.argsort(flat, kind="stable")
        self.row, self.place = post // self.length, (post % self.length).astype(np.int32)
        self.first = np.searchsorted(flat[post], np.arange(pivots + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row to a query's order, less a constant; by the lists of its pivots."""
        total = np.zeros(len(self.ids), np.int32)
        for j, p in enumerate(order.tolist()):
            a, b = self.first[p], self.first[p + 1]
            total[self.row[a:b]] += np.abs(self.place[a:b] - j) - (self.length - j)
        return total

    def nearest(self, query: int, v: np.ndarray, order: np.ndarray, share: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` rows among the closest share by footrule."""
        distance = self.footrule(order)
        keep = max(math.ceil(share * len(self.ids)), LEAST * k + 1)
        pick = np.arange(len(self.ids))
        if keep < len(pick):
            cut = np.partition(distance, keep - 1)[keep - 1]
            pick = np.concatenate([np.flatnonzero(distance < cut), np.flatnonzero(distance == cut)])[:keep]
        pick = pick[self.ids[pick] != query]
        score = np.einsum("ij,j->i", self.x[pick], v)
        best = np.lexsort((self.ids[pick], -score))[:k]
        return self.ids[pick][best], score[best]


def pivots_of(rows: DataFrame, pivots: int = PIVOTS) -> dict[int, Pivots]:
    """At most ``pivots`` rows of every vector length, chosen by a hash of their id."""
    w = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id")
    top = rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= pivots).select("dim", "embedding")
    by_dim: dict[int, list] = {}
    for r in top.collect():  # bounded: pivots rows a length
        by_dim.setdefault(r.dim, []).append(r.embedding)
    return {d: Pivots(np.array(v, float)) for d, v in by_dim.items()}


def fit_share(rows: DataFrame, pivots: dict[int, Pivots], k: int, recall: float) -> float:
    """The smallest share of a shard to rank again at which sampled queries find ``recall`` of
    their true neighbours within a sample of at most ``SAMPLE`` rows."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(SAMPLE).collect()
    found = np.zeros((0, len(SHARES)))
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r.dim, []).append(r)
    for dim, mine in by_dim.items():
        if dim not in pivots or len(mine) < 2:
            continue
        ids, x = np.array([r.vec_id for r in mine]), np.array([r.embedding for r in mine], float)
        order = pivots[dim].order(x)
        shard = Shard(ids, x, order, len(pivots[dim].unit))
        hits = []
        for i in range(min(SAMPLE_QUERIES, len(mine))):
            score = np.einsum("ij,j->i", shard.x, x[i])
            score[shard.ids == ids[i]] = -np.inf
            true = np.lexsort((shard.ids, -score))[:min(k, len(ids) - 1)]
            place = np.empty(len(ids), np.int64)
            place[np.argsort(shard.footrule(order[i]), kind="stable")] = np.arange(len(ids))
            hits.append([(place[true] < s * len(ids)).mean() for s in SHARES])
        found = np.concatenate([found, hits])
    if not len(found):
        return 1.0
    ok = np.flatnonzero(found.mean(axis=0) >= recall)
    return SHARES[int(ok[0])] if len(ok) else 1.0


def _indexer(pivots: dict[int, Pivots]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                for at in range(0, int((dims == dim).sum()), 1024):
                    part = batch.take(pa.array(np.flatnonzero(dims == dim)[at:at + 1024]))
                    x = _matrix(part.column(2), int(dim))
                    order = pivots[int(dim)].order(x)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary()),
                                                      pa.array([r.tobytes() for r in order], pa.binary())], ["vec_id", "dim", "vector", "pivots"])
    return run


def build(rows: DataFrame, pivots: dict[int, Pivots]) -> DataFrame:
    """The index, written: vec_id, dim, shard, vector (float64), pivots (int16, nearest first) of every row."""
    table = rows.select("vec_id", "dim", "embedding").mapInArrow(_indexer(pivots), "vec_id long, dim int, vector binary, pivots binary")
    return write_table(table, "permutation-index")


def _searcher(counts: dict[int, int], share: float, k: int):
    """(query_id, ids, scores) of the best rows of one shard, from rows sorted so that a shard's rows come before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        for batch in batches:
            dims, shards, kinds = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dims)]):
                if a == b:
                    continue
                dim = int(dims[a])
                ids = batch.column(3).slice(a, b - a).to_numpy()
                x = np.frombuffer(b"".join(batch.column(4).slice(a, b - a).to_pylist())).reshape(b - a, dim)
                order = np.frombuffer(b"".join(batch.column(5).slice(a, b - a).to_pylist()), np.int16).reshape(b - a, -1)
                if (dim, int(shards[a])) != key:
                    key, held, shard = (dim, int(shards[a])), [], None
                if kinds[a] == 0:
                    held.append((ids, x, order))
                    continue
                if shard is None:
                    if not held:
                        continue
                    shard, held = Shard(*(np.concatenate(c) for c in zip(*held)), counts[dim]), []
                got = [shard.nearest(int(ids[i]), x[i], order[i], share, k) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([g[0] for g in got], pa.list_(pa.int64())),
                                                  pa.array([g[1] for g in got], pa.list_(pa.float64()))], ["query_id", "ids", "scores"])
    return run


def search(index: DataFrame, queries: DataFrame, pivots: dict[int, Pivots], share: float, k: int = 20, shard_rows: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every row of ``queries`` (rows of the index)."""
    n = max(1, math.ceil(index.count() / shard_rows))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    kind = lambda x: F.lit(x).cast("int").alias("kind")
    cols = ["dim", "shard", "kind", "vec_id", "vector", "pivots"]
    rows = index.select("*", shard.alias("shard"), kind(0)).select(*cols)
    asked = queries.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"), kind(1)).select(*cols)
    met = rows.unionByName(asked).repartition(n, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    counts = {d: len(p.unit) for d, p in pivots.items()}
    found = met.mapInArrow(_searcher(counts, share, k), "query_id long, ids array<long>, scores array<double>")
    one = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("f")).select("query_id", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, wanted: Column, k: int = 20, recall: float = 0.95) -> DataFrame:
    """query_id, rank, vec_id, score: for every row where ``wanted`` holds its ``k`` nearest others."""
    rows = write_table(usable(vectors), "vectors")
    pivots = pivots_of(rows)
    share = fit_share(rows, pivots, k, recall)
    index = build(rows, pivots)
    return search(index, index.filter(wanted), pivots, share, k)
