"""Suffix-array dedup with sparse suffix arrays.

Of each document only the suffixes at minimiser positions are retained: places whose
``GRAM``-word hash is the smallest of a window, so that every run of ``min_words`` words
holds one, chosen by its content alone.  A first sort of the retained suffixes by their
leading ``GRAM`` words drops those without a neighbour of another document.  The others are
dealt by their leading words, sorted by all their words and compared with their neighbours: the
number of leading words that two have in common, over the sorted order, tells how far any of
them match to the right.  Matches are then extended to the left a word at a time, and what
reaches ``min_words`` words in all and is found in two documents is repeated.

A suffix carries the words that its windows of ``min_words`` words can reach (fewer than
2 * ``min_words``); a window belongs to its first smallest place.  Equal leading words go to one task,
unless more than ``PIECE`` suffixes have them (more than a ``HOT``-th of all, in large inputs): these are dealt
over as many tasks as their count needs.  Tasks work on pieces of about ``PIECE`` suffixes.  Where leading
words go on in another task or piece, all is known of a window but whether the smallest document of
the piece has a smaller one, or any other, elsewhere: that document's row is handed on, so a passage in a
third of all documents meets in no task.

Words are runs without ASCII white space, A-Z lowered; spans count words, end exclusive.
A result row is a document with at least one repeated span.  Documents equal as a whole are
one class: a single copy takes part in the search, and each member is repeated as a whole.

Defined cases: null, empty and short texts have no span; rows without doc_id take no
part; rows that share a doc_id are one document (equal texts do not repeat each other, the
spans of unequal ones are joined); an empty table gives no rows; other columns are not read;
``min_words`` below ``GRAM`` is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Words, _mix, drop_table, ngram_hash, shuffle_partitions, splitmix, text_slices, write_table

GRAM = 11
#: Suffixes of a sorted range that are compared in one step.
PIECE = 8192
#: Most runs of leading words that can be dealt over several tasks (8 + 8 bytes each are sent to the tasks).
HOT = 1 << 16


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over every run of ``w`` values, by prefix and suffix runs of blocks of w."""
    n = len(x) - w + 1
    fill = np.iinfo(np.uint64).max if op is np.minimum else np.uint64(0)
    blocks = np.append(x, np.full(-len(x) % w, fill, x.dtype)).reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).ravel()
    behind = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:n], ahead[w - 1:w - 1 + n])


def minimisers(h: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hashes, smallest gram of every window of ``min_words`` words, places that are the
    smallest of some window) of one document's word hashes."""
    w = min_words - GRAM + 1
    g = ngram_hash(h, GRAM)
    if len(g) < w:
        return g, g[:0], np.zeros(0, np.int64)
    low = _sliding(g, w, np.minimum)
    around = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
    return g, low, np.flatnonzero(_sliding(around, w, np.maximum) == g)


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each text of the second column."""
    for a, _, data, offsets in text_slices(batch.column(1)):
        w = Words(data, offsets, lower=True)
        for i, (x, y) in enumerate(zip(w.first.tolist(), w.first[1:].tolist())):
            yield a + i, w.hash[x:y]


def _outline(docs: DataFrame, min_words: int) -> DataFrame:
    """Per document of ``min_words`` words: its length, two hashes of all its words, its distinct minimisers and
    how many places each has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for i, h in _documents(batch):
                if len(h) >= min_words:
                    g, _, at = minimisers(h, min_words)
                    with np.errstate(over="ignore"):
                        m = splitmix(len(h), 5)
                        whole = [int(x.view(np.int64)) for x in (_mix((h * m).sum(keepdims=True))[0], _mix((_mix(h + m) ^ m).sum(keepdims=True))[0])]
                    keys, places = np.unique(g[at], return_counts=True)
                    rows.append((ids[i], len(h), *whole, keys.view(np.int64), places))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[k] for r in rows], pa.int64()) for k in range(4)), *(pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (4, 5))],
                ["doc_id", "n_words", "w1", "w2", "keys", "places"])

    return (docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
            .mapInArrow(run, "doc_id long, n_words long, w1 long, w2 long, keys array<long>, places array<long>"))


def _surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, doc_id) rows those with a neighbour of equal key.  The first and the last key of
    the range survive as well: their neighbours may be in another range."""
    held, first = None, None
    for batch in batches:
        key, doc = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(key):
            continue
        first = key[0] if first is None else first
        if held is not None:
            key, doc = np.concatenate([held[0], key]), np.concatenate([held[1], doc])
        same = key[1:] == key[:-1]
        keep = np.append(False, same) | np.append(same, False) | (key == first)
        keep[-1] = False  # decided with the next batch
        yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(doc[keep])], ["key", "doc_id"])
        held = key[-2:], doc[-2:]
        if len(key) > 1 and keep[-2]:
            held = key[-2:].copy(), doc[-2:].copy()
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[0][-1:]), pa.array(held[1][-1:])], ["key", "doc_id"])


def _suffixes(min_words: int):
    """Texts with their surviving minimisers -> (key, doc_id, at, left, right): the hash of the leading words, the
    place, the words before it, backward, and those from it on, as far as windows reach whose smallest gram is there."""
    w = min_words - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(2)
            for i, h in _documents(batch):
                g, low, at = minimisers(h, min_words)
                at = at[np.isin(g[at], keys[i].values.to_numpy().view(np.uint64))]
                order = np.lexsort((at, g[at]))
                same = np.append(False, g[at][order][1:] == g[at][order][:-1])
                ahead = np.full(len(at), -1)  # the last place before with the same gram; a window belongs to its first smallest one
                ahead[order[1:]] = np.where(same[1:], at[order[:-1]], -1)
                for x in range(0, len(at), 4096):
                    p = at[x:x + 4096]
                    start = p[:, None] - np.arange(w - 1, -1, -1)  # windows that hold the place; those it is smallest in are a run
                    fits = (start >= 0) & (start < len(low))
                    fits &= (low[np.clip(start, 0, len(low) - 1)] == g[p][:, None]) & (start > ahead[x:x + 4096, None])
                    owns = fits.any(axis=1)
                    p, start, fits = p[owns], start[owns], fits[owns]
                    first = start[np.arange(len(p)), fits.argmax(axis=1)]
                    end = first + fits.sum(axis=1) - 1 + min_words
                    left = [h[b:a][::-1].tobytes() for a, b in zip(p.tolist(), first.tolist())]
                    right = [h[a:b].tobytes() for a, b in zip(p.tolist(), end.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[p].view(np.int64)), pa.array(np.full(len(p), ids[i])), pa.array(p.astype(np.int64)), pa.array(left, pa.binary()),
                         pa.array(right, pa.binary())], ["key", "doc_id", "at", "left", "right"])
    return run


def _matrix(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row (0 behind the last), and their number."""
    column = column.combine_chunks().cast(pa.large_binary())
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    words = np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(np.uint64) if at[-1] > at[0] else np.zeros(0, np.uint64)
    n = np.diff(at) // 8
    out = np.zeros((len(n), width), np.uint64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(words)) - (np.cumsum(n) - n)[row]] = words
    return out, n


def _common_words(right: np.ndarray) -> np.ndarray:
    """Leading words that each row has in common with the one before."""
    differ = np.append(right[1:] != right[:-1], np.ones((len(right) - 1, 1), bool), axis=1)
    return np.append(0, differ.argmax(axis=1))


def _matches(doc: np.ndarray, left: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, common: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """For each suffix and each number of words to its left, whether that window of ``min_words`` words is
    there, and the smallest and the largest document with it.  Rows are in the order of the suffixes."""
    m, w = len(doc), min_words - GRAM + 1
    there = np.zeros((m, w), bool)
    low, high = np.zeros((m, w), np.int64), np.zeros((m, w), np.int64)
    before = np.zeros(m, np.int64)  # numbers the distinct runs of words to the left
    for words in range(w):
        if words:
            _, x = np.unique(left[:, words - 1], return_inverse=True)
            _, before = np.unique(before * m + x, return_inverse=True)
        behind = np.cumsum(common < min_words - words)  # numbers the distinct runs to the right
        at = np.flatnonzero((n_left >= words) & (n_right >= min_words - words))
        if not len(at):
            continue
        key = behind[at] * m + before[at]
        order = np.lexsort((doc[at], key))
        at, key = at[order], key[order]
        begin = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(begin) - 1
        there[at, words] = True
        low[at, words] = doc[at][begin][group]
        high[at, words] = doc[at][np.append(begin[1:], True)][group]
    return there, low, high


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of true flags in each row."""
    edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


_EXTENDED = "doc_id long, start long, end long, removed boolean, window long, high long"


def _extended(min_words: int):
    """Sorted suffixes -> spans (``window`` null), and windows handed on: the smallest document of a piece,
    its place, the hash of the words and the largest document of the piece."""
    names = ["doc_id", "start", "end", "removed", "window", "high"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]

    def work(t: pa.Table, elsewhere: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc, at = (t.column(c).to_numpy() for c in ("doc_id", "at"))
        left, n_left = _matrix(t.column("left"), min_words - GRAM)
        right, n_right = _matrix(t.column("right"), min_words)
        there, low, high = _matches(doc, left, n_left, n_right, _common_words(right), min_words)
        later = there & (doc[:, None] > low)
        for flags, removed in ((there & (low < high), False), (later, True)):
            row, first, last = _runs(flags)
            n = len(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[row]), pa.array(at[row] - last), pa.array(at[row] - first + min_words), pa.array(np.full(n, removed)),
                 pa.nulls(n, types[4]), pa.nulls(n, types[5])], names)
        row, words = np.nonzero(there & ~later & elsewhere[:, None])
        if len(row):
            # all windows of a suffix lie in one line of its words, the place itself in column min_words - GRAM
            line = np.concatenate([left[:, ::-1], right], axis=1)
            window = ngram_hash(line.ravel(), min_words)[row * line.shape[1] + min_words - GRAM - words].view(np.int64)
            start, high = at[row] - words, high[row, words]
            for a in range(0, len(row), 1 << 16):
                k = slice(a, min(a + (1 << 16), len(row)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[row[k]]), pa.array(start[k]), pa.array(start[k] + min_words), pa.nulls(k.stop - a, types[3]), pa.array(window[k]),
                     pa.array(high[k])], names)

    def wide(t: pa.Table) -> np.ndarray:
        return t.column("wide").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        begun = False  # the first key held goes on from the piece before
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for a in range(0, len(t), PIECE):
                part = t.slice(a, PIECE)
                held = part if held is None else pa.concat_tables([held, part])
                if len(held) < PIECE:
                    continue
                key = held.column("key").to_numpy()
                end = int(np.flatnonzero(key == key[-1])[0]) or len(key)  # the last key may go on; a piece of one key goes as it is
                yield from work(held.slice(0, end), begun & (key[:end] == key[0]) | (end == len(key)) | wide(held)[:end])
                begun, held = end == len(key), held.slice(end)
        if held is not None and len(held):
            key = held.column("key").to_numpy()
            yield from work(held, begun & (key == key[0]) | wide(held))

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each document -> those that touch as one."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def union(start: np.ndarray, end: np.ndarray) -> list[dict]:
        if not len(start):
            return []
        order = np.argsort(start, kind="stable")
        start, end = start[order], np.maximum.accumulate(end[order])
        cut = np.flatnonzero(start[1:] > end[:-1])
        return [{"start": a, "end": b} for a, b in zip(start[np.append(0, cut + 1)].tolist(), end[np.append(cut, len(start) - 1)].tolist())]

    for batch in batches:
        repeated, removed = [], []
        for x in batch.column(1):
            start, end = (x.values.field(c).to_numpy() for c in ("start", "end"))
            gone = x.values.field("removed").to_numpy(zero_copy_only=False)
            repeated.append(union(start[~gone], end[~gone]))
            removed.append(union(start[gone], end[gone]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(repeated, kind), pa.array(removed, kind)], ["doc_id", "repeated", "removed"])


def repeated_spans(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """doc_id, repeated, removed for each document with a run of ``min_words`` words that another
    document has too.  ``repeated`` are the joined runs; ``removed`` those that a smaller doc_id has."""
    if min_words < GRAM:
        raise ValueError(f"min_words must be {GRAM} or more")
    outline = write_table(_outline(docs, min_words), "suffix-outline")
    whole = ["n_words", "w1", "w2"]
    classes = outline.groupBy(*whole).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    member = outline.drop("keys", "places").join(classes, whole).filter("rep < last")
    both = lambda later: F.explode(F.when(later, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("removed")
    copies = member.select("doc_id", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"), both(F.col("doc_id") > F.col("rep")))

    reps = outline.join(classes.select(*whole, F.col("rep").alias("doc_id")), [*whole, "doc_id"], "left_semi")
    n = shuffle_partitions(docs.sparkSession)
    keys = write_table(reps.select(F.explode(F.arrays_zip("keys", "places")).alias("k"), "doc_id").select("k.keys", "k.places", "doc_id").toDF("key", "places", "doc_id"), "suffix-keys")
    alike = (keys.drop("places").repartitionByRange(n, "key", "doc_id").sortWithinPartitions("key", "doc_id")
             .mapInArrow(_surviving, "key long, doc_id long").groupBy("doc_id").agg(F.collect_set("key").alias("keys")))
    texts = docs.select("doc_id", "text").join(alike, "doc_id").select("doc_id", "text", "keys")
    suffixes = texts.mapInArrow(_suffixes(min_words), "key long, doc_id long, at long, left binary, right binary")
    bound = max(PIECE, -(-(keys.agg(F.sum("places")).first()[0] or 0) // HOT))
    hot = keys.groupBy("key").agg(F.sum("places").alias("c")).filter(F.col("c") > bound).select("key", F.ceil(F.col("c") / bound).alias("tasks"))
    dealt = (suffixes.join(F.broadcast(hot), "key", "left")  # checked: fewer than HOT rows
             .withColumn("wide", F.col("tasks").isNotNull()).withColumn("task", F.coalesce(F.pmod(F.xxhash64("doc_id", "at"), "tasks"), F.lit(0))).drop("tasks"))
    spans = write_table(dealt.repartition(n, "key", "task").sortWithinPartitions("key", "right", "doc_id", "at", "left")
                        .mapInArrow(_extended(min_words), _EXTENDED), "suffix-spans")
    drop_table(keys)

    windows = spans.filter("window IS NOT NULL")
    twice = windows.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("high").alias("most")).filter("low < most")
    handed = windows.join(twice, "window").select("doc_id", "start", "end", both(F.col("doc_id") > F.col("low")))
    found = spans.filter("window IS NULL").select("doc_id", "start", "end", "removed")
    return (found.unionByName(handed).unionByName(copies).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "removed")).alias("spans"))
            .mapInArrow(_joined, "doc_id long, repeated array<struct<start:long,end:long>>, removed array<struct<start:long,end:long>>"))
