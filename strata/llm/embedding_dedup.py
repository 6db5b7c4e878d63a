"""Embedding near-dedup by spherical-cap filters.

Filter directions are the words of a structured random product code: after a random
rotation the coordinates fall into blocks, each with its own random unit vectors, and a
direction is one choice per block.  A vector is list-decoded, block by block with bounds, to
all directions whose inner product exceeds a threshold.  Vectors of equal label that share
a filter meet, and their cosine is verified in double precision.  The number of
directions follows the number of vectors; the threshold is the largest at which simulated
pairs at the wanted cosine still share a filter with the wanted recall.

Equal vectors are one class with a weight.  A filter with very many members is cut into
blocks that meet pairwise, so that a task holds two blocks at most.  A pair counts in its
first common filter only; what leaves a task is one row per vector and block, never pairs.

Defined cases: null labels, and vectors that are null, empty, zero or hold null or
non-finite components, link with nothing; vectors of different lengths do not link; rows
that share vec_id, label and vector are one vector; rows without vec_id link with nothing
and have a null component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import components, shuffle_partitions, write_table

#: Independent rotations, each with its own codes.
ROTATIONS = 4
#: Members of one filter that meet in one task; more are cut into blocks of this size.
BLOCK_SIZE = 1024
SEED = 20_240


class Code:
    """Directions for vectors of ``dim`` components: ``size`` choices in each of ``blocks`` blocks."""

    def __init__(self, dim: int, blocks: int, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.parts = np.array_split(np.arange(dim), min(blocks, dim))
        self.codes = []
        for p in self.parts:
            c = rng.standard_normal((size, len(p)))
            self.codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(len(self.parts)))
        self.size = size

    def products(self, u: np.ndarray) -> list[np.ndarray]:
        r = u @ self.rotation
        return [r[:, p] @ c.T for p, c in zip(self.parts, self.codes)]

    def best_shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair the best, over all directions, of the smaller of its two inner products."""
        x, y = (np.zeros((len(a), 1)) for _ in "ab")
        for p, q in zip(self.products(a), self.products(b)):
            x, y = ((s[:, :, None] + t[:, None, :]).reshape(len(a), -1) for s, t in ((x, p), (y, q)))
        return np.minimum(x, y).max(axis=1)

    def decode(self, u: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) above the threshold; partial sums that cannot reach it any more are left out."""
        products = self.products(u)
        rest = np.zeros((len(products) + 1, len(u)))
        for k in range(len(products) - 1, 0, -1):
            rest[k] = rest[k + 1] + products[k].max(axis=1)
        row, code, total = np.arange(len(u)), np.zeros(len(u), np.int64), np.zeros(len(u))
        for k, p in enumerate(products):
            t = total[:, None] + p[row]
            i, j = np.nonzero(t + rest[k + 1][row][:, None] >= threshold)
            row, code, total = row[i], code[i] * self.size + j, t[i, j]
        return row, code


class Filters:
    """The codes of all rotations under one threshold, tuned on simulated pairs."""

    def __init__(self, dim: int, blocks: int, size: int, cosine: float, recall: float, pairs: int = 1000):
        self.codes = [Code(dim, blocks, size, SEED + 100 * dim + r) for r in range(ROTATIONS)]
        rng = np.random.default_rng(SEED)
        a, b = rng.standard_normal((2, pairs, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(1, keepdims=True) * a
        b = cosine * a + np.sqrt(1 - cosine ** 2) * b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
        step = max(1, (1 << 21) // size ** len(self.codes[0].parts))
        best = [np.max([c.best_shared(a[i:i + step], b[i:i + step]) for c in self.codes], axis=0) for i in range(0, pairs, step)]
        self.threshold = float(np.quantile(np.concatenate(best), 1 - recall))

    def decode(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every direction above the threshold, by row and ascending filter."""
        got = [c.decode(u, self.threshold) for c in self.codes]
        per = self.codes[0].size ** len(self.codes[0].parts)
        row = np.concatenate([r for r, _ in got])
        code = np.concatenate([f + k * per for k, (_, f) in enumerate(got)])
        order = np.lexsort((code, row))
        return row[order], code[order]


@functools.lru_cache(maxsize=16)
def _filters(dim: int, blocks: int, size: int, cosine: float, recall: float) -> Filters:
    return Filters(dim, blocks, size, cosine, recall)


def code_shape(n: int) -> tuple[int, int]:
    """(blocks, choices in a block) for ``n`` vectors: about n / 32 directions a rotation."""
    size = round((n / 32) ** 0.5)
    return (2, max(8, size)) if size <= 400 else (3, round((n / 32) ** (1 / 3)))


def _unit(raw: np.ndarray) -> np.ndarray:
    raw = raw.astype(float)
    x = raw / np.abs(raw).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _decoder(blocks: int, size: int, cosine: float, recall: float):
    """Rows (label, dim, filter, id, weight, vector, all its filters) of (id, label, weight, embedding)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                ids, label, weight, emb = (c.slice(at, 128) for c in batch.columns)
                length = emb.value_lengths().to_numpy()
                for dim in np.unique(length):
                    pick = np.flatnonzero(length == dim)
                    raw = np.array(emb.take(pa.array(pick)).flatten().to_numpy()).reshape(len(pick), dim)
                    row, code = _filters(int(dim), blocks, size, cosine, recall).decode(_unit(raw))
                    mine = np.split(code, np.cumsum(np.bincount(row, minlength=len(pick)))[:-1])
                    vec, lists, back = [x.tobytes() for x in raw], [x.tobytes() for x in mine], pa.array(pick[row])
                    yield pa.RecordBatch.from_arrays(
                        [label.take(back).cast(pa.string()), pa.array(np.full(len(row), dim, np.int32)), pa.array(code),
                         ids.take(back), weight.take(back), pa.array([vec[i] for i in row.tolist()], pa.binary()),
                         pa.array([lists[i] for i in row.tolist()], pa.binary())],
                        ["label", "dim", "filter", "id", "weight", "vector", "filters"])
    return run


def _links(cosine: float, kind: str):
    """Per member of a filter (or of two of its blocks): the weight of what it links with there for the
    first time, and the smallest id it is connected with there."""

    def meet(filter_id: int, ids: np.ndarray, weight: np.ndarray, u: np.ndarray, lists: list[np.ndarray], side: np.ndarray) -> tuple | None:
        link = u @ u.T >= cosine
        np.fill_diagonal(link, False)
        if side.any() or len(np.unique(side)) > 1:  # two blocks: only pairs across
            link &= side[:, None] != side[None, :]
        hit = np.flatnonzero(link.any(axis=1))
        if not len(hit):
            return None
        link = link[np.ix_(hit, hit)]
        earlier = [x[x < filter_id] for x in (lists[i] for i in hit)]
        known, place = np.unique(np.concatenate(earlier), return_inverse=True)
        has = np.zeros((len(hit), len(known)), np.float32)
        has[np.repeat(np.arange(len(hit)), [len(x) for x in earlier]), place] = 1
        fresh = link & (has @ has.T == 0)
        low = ids[hit].copy()
        while True:  # smallest id over links, until nothing changes
            new = np.minimum(low, np.where(link, low[None, :], np.iinfo(np.int64).max).min(axis=1))
            if np.array_equal(new, low):
                break
            low = new
        return ids[hit], fresh @ weight[hit], low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "low"]
        held: list[pa.RecordBatch] = []

        def groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key = [table.column(k).to_numpy() for k in ("code", "filter", "i", "j")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            ids, weight = table.column("id").to_numpy(), table.column("weight").to_numpy().astype(float)
            vector, lists, part = table.column("vector"), table.column("filters"), table.column("part").to_numpy()
            out: list[tuple] = []
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(ids)]):
                if b - a > 1:
                    u = _unit(np.frombuffer(b"".join(vector.slice(a, b - a).to_pylist()), kind).reshape(b - a, -1))
                    if key[2][a] == key[3][a]:
                        side = np.zeros(b - a, int)
                    else:
                        side = (part[a:b] == key[3][a]).astype(int) + 1
                    got = meet(int(key[1][a]), ids[a:b], weight[a:b], u, [np.frombuffer(x, np.int64) for x in lists.slice(a, b - a).to_pylist()], side)
                    if got:
                        out.append(got)
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1].astype(np.int64)), pa.array(cols[2])], names)

        for batch in batches:
            # the last group of a batch may go on in the next one
            code, f, i, j = (batch.column(batch.schema.get_field_index(k)).to_numpy() for k in ("code", "filter", "i", "j"))
            last = np.flatnonzero((code != code[-1]) | (f != f[-1]) | (i != i[-1]) | (j != j[-1])) if len(batch) else []
            if len(batch) and len(last) == 0 and held and _same_group(held[-1], batch):
                held.append(batch)
                continue
            end = int(last[-1]) + 1 if len(last) else 0
            if end or held:
                yield from groups(pa.Table.from_batches([*held, batch.slice(0, end)], batch.schema))
            held = [batch.slice(end)] if len(batch) else held
        if held:
            yield from groups(pa.Table.from_batches(held))

    return run


def _same_group(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
    return all(a.column(a.schema.get_field_index(k))[-1] == b.column(b.schema.get_field_index(k))[0] for k in ("code", "filter", "i", "j"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, recall: float = 0.97) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    n = shuffle_partitions(vectors.sparkSession)
    good = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.coalesce(F.size("embedding"), F.lit(0)) > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(good, F.lit(False)).alias("good"))
    classes = write_table(rows.filter("good").dropDuplicates(["vec_id", "label", "embedding"]).groupBy("label", "embedding")
                          .agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vector-classes")
    kind = "f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "f8"
    entries = classes.select(F.col("rep").cast("long").alias("id"), "label", "weight",
                             F.col("embedding").cast(T.ArrayType(T.FloatType() if kind == "f4" else T.DoubleType())).alias("embedding"))
    entries = entries.mapInArrow(_decoder(*code_shape(classes.count()), cosine, recall),
                                 "label string, dim int, filter long, id long, weight long, vector binary, filters binary")
    # one number for label and length, so that a group is told by numbers alone
    entries = entries.withColumn("code", F.xxhash64("label", "dim")).drop("label", "dim")
    members = entries.groupBy("code", "filter").agg(F.count("*").alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK_SIZE).cast("int")
    met = (entries.join(members, ["code", "filter"]).withColumn("blocks", blocks)
           .withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("other", "blocks", "members")
           .repartition(n, "code", "filter", "i", "j").sortWithinPartitions("code", "filter", "i", "j"))
    found = write_table(met.mapInArrow(_links(cosine, kind), "id long, n long, low long"), "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    comp = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    of_class = (classes.select("label", "embedding", "rep", "weight")
                .join(counts, F.col("rep") == F.col("id"), "left").drop("id")
                .join(comp, F.col("rep") == F.col("id"), "left").drop("id"))
    r, c = rows.alias("r"), of_class.alias("c")
    out = r.join(c, F.expr("r.good AND r.label = c.label AND r.embedding = c.embedding"), "left")
    component = F.coalesce(F.col("c.component"), F.col("c.rep"), F.col("r.vec_id"))
    return out.select("r.vec_id", (F.coalesce(F.col("c.n"), F.lit(0)) + F.coalesce(F.col("c.weight") - 1, F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("r.vec_id"), F.lit(True)).alias("kept"))
