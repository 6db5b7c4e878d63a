"""Document fingerprints: one-permutation MinHash of 5-word shingles.

Every shingle is hashed once; the top bits choose one of ``BINS`` bins and each bin keeps
its smallest hash.  An empty bin copies the first filled one on its own fixed random walk
over the bins (optimal densification).  Of each bin the low ``BITS`` bits are stored,
packed; two fingerprints agree in a bin by chance with probability 2**-BITS, which the
likeness takes off again.

Defined cases: null texts are empty; a text of fewer than five words is one shingle; a
text without words has the empty fingerprint, alike (1.0) with another empty one and with
nothing else (0.0); equal texts have equal fingerprints.  For ``edited_neighbours`` rows
without doc_id come first and rows that share one are ordered by text; a lone row is its
own next document.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import SLICE_BYTES, Words, _mix, range_buckets, shuffle_partitions, text_slices

SHINGLE = 5
BINS, BITS = 512, 4
STEPS = 64     # of the walks of a block's texts taken at once
BLOCK = 256    # texts whose bins are filled at once
_FIRST = -(1 << 63)  # orders rows without doc_id


def _walk(steps: np.ndarray) -> np.ndarray:
    """The bins (a row for each bin) that the fixed random walks of all bins come to at ``steps``."""
    with np.errstate(over="ignore"):
        at = np.arange(BINS, dtype=np.uint64)[:, None] * np.uint64(1 << 32) + steps.astype(np.uint64)
        return (_mix(at) % np.uint64(BINS)).astype(np.int64)


@functools.cache
def _walks() -> tuple[np.ndarray, np.ndarray]:
    """The first ``STEPS`` bins of every walk, a row for each step, and the step at which the walk of
    a bin (row) first comes to another one (column)."""
    first, start = np.full((BINS, BINS), np.iinfo(np.int32).max, np.int32), 1
    rows = np.arange(BINS)
    missing = True
    while missing:
        bins = _walk(np.arange(start, start + BINS))
        for k in range(BINS):
            at = bins[:, k]
            first[rows, at] = np.minimum(first[rows, at], start + k)
        start += BINS
        missing = bool((first == np.iinfo(np.int32).max).any())
    return np.ascontiguousarray(_walk(np.arange(1, STEPS + 1)).T), first


def _densify(low: np.ndarray, filled: np.ndarray) -> None:
    """Fill the empty bins of texts (rows, at least one bin filled in each) in place: ``STEPS`` steps of the
    walks of all texts at once; the few bins left, of texts with few filled ones, by the table of first steps."""
    steps, first = _walks()
    flat, full = low.ravel(), filled.ravel()
    empty = np.flatnonzero(~full)
    for bins in steps:
        if not len(empty):
            return
        own = empty & (BINS - 1)
        source = empty - own + bins[own]
        hit = full[source]
        flat[empty[hit]] = flat[source[hit]]
        empty = empty[~hit]
    if not len(empty):
        return
    text, own = empty // BINS, empty % BINS
    cuts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(text)]):
        have = np.flatnonzero(filled[text[a]])
        low[text[a], own[a:b]] = low[text[a], have[first[own[a:b][:, None], have].argmin(axis=1)]]


def signatures(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Low bits of the densified bins of each text; an empty array for a text without words."""
    h, bounds = Words(data, offsets, lower=True).shingles(SHINGLE)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    out: list[np.ndarray] = [np.zeros(0, np.uint8)] * (len(bounds) - 1)
    some = np.flatnonzero(np.diff(bounds))
    for a in range(0, len(some), BLOCK):
        block = some[a:a + BLOCK]
        lo, hi = bounds[block[0]], bounds[block[-1] + 1]           # texts between two of them have no shingles
        part = h[lo:hi]
        place = np.repeat(np.arange(len(block)) * BINS, bounds[block + 1] - bounds[block]) + (part >> shift).astype(np.int64)
        smallest = np.full(len(block) * BINS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(smallest, place, part)
        filled = np.zeros(len(block) * BINS, bool)
        filled[place] = True
        low = (smallest & np.uint64((1 << BITS) - 1)).astype(np.uint8).reshape(-1, BINS)
        _densify(low, filled.reshape(-1, BINS))
        for k, row in zip(block.tolist(), low):
            out[k] = row
    return out


def pack(signature: np.ndarray) -> str:
    """Hexadecimal digits, one bin each."""
    return (signature[::2] << 4 | signature[1::2]).tobytes().hex()


def unpack(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return np.column_stack([raw >> 4, raw & 15]).ravel()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimate of the Jaccard similarity of two shingle sets, corrected for chance agreement."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    chance = 2.0 ** -BITS
    return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def _of(texts: list[str]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, _, data, offsets in text_slices(pa.array(texts, pa.large_string())):
        out += signatures(data, offsets)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(list(map(pack, signatures(data, offsets))))],
                                                 ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def _with_next(docs: DataFrame) -> DataFrame:
    """(bucket, ahead, key, doc_id, text) by ranges of doc_id, one partition each, sorted; every
    range ends with the first rows of the one after it (ahead = 1; after the last: the first).

    One shuffle of the texts; the driver holds one bound and one first doc_id per range."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))
    ids = docs.select(key.alias("key"))
    bounds = np.array(range_buckets(ids, "key", n), np.int64)

    @F.pandas_udf("int")
    def bucket(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int32))

    first = {r["b"]: r["k"] for r in ids.groupBy(bucket("key").alias("b")).agg(F.min("key").alias("k")).collect()}
    used = sorted(first)
    before = {first[b]: p for p, b in zip([used[-1], *used], used)} if used else {}

    @F.pandas_udf("b int, ahead_of int")
    def places(k: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"b": np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int32),
                             "ahead_of": k.map(lambda x: before.get(x, -1)).astype(np.int32)})

    placed = docs.select(key.alias("key"), "doc_id", "text", places(key).alias("p"))
    copies = F.expr("filter(array(named_struct('b', p.b, 'ahead', 0), named_struct('b', p.ahead_of, 'ahead', 1)), x -> x.b >= 0)")
    return (placed.select("key", "doc_id", "text", F.inline(copies))
            .repartitionById(max(1, len(bounds) + 1), F.col("b"))
            .sortWithinPartitions("b", "ahead", "key", "text")
            .select("b", "ahead", "doc_id", "text"))


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Each document, its edited text (the last half replaced by the start of the next document), both
    fingerprints, and their likenesses: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    import hashlib

    def flush(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        ids, texts, nexts = zip(*rows)
        edited = [t[:len(t) - len(t) // 2] + x[:len(t) // 2] for t, x in zip(texts, nexts)]
        own, other = _of([*texts, nexts[-1]]), _of(edited)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
             pa.array([pack(s) for s in own[:-1]]), pa.array([pack(s) for s in other]),
             pa.array([likeness(a, b) for a, b in zip(own, other)]),
             pa.array([likeness(a, b) for a, b in zip(own, own[1:])])],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one
        chunk: list[tuple[int | None, str, str]] = []
        size, ended = 0, None
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                for b, ahead, doc, text in zip(*(c.to_pylist() for c in part.columns)):
                    text = text or ""
                    if ahead and ended == b:
                        continue  # only the first row after a range counts
                    if held is not None:
                        chunk.append((*held, text))
                        size += len(held[1]) + len(text)
                        if size >= SLICE_BYTES:
                            yield flush(chunk)
                            chunk, size = [], 0
                    held, ended = (None, b) if ahead else ((doc, text), ended)
        if chunk:
            yield flush(chunk)

    return _with_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                            "edited_fingerprint string, near_edited double, near_next double")
