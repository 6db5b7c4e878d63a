"""Filter interaction audit.

Five filters judge every whole text: A too few words, B too few distinct words, C too many
capitals, D holds a mark, E the text of a smaller doc_id.  One table-driven pass over the UTF-8
bytes (``NEXT`` and ``EMIT`` by state and byte class) counts words, capitals, code points and marks
and gives the word spans; these go into an open-addressing hash table, where a span joins a
slot only after its bytes were compared with those of the slot's owner, so the distinct count
is exact.  From the texts on only failure masks travel: documents are counted by part and mask, and
all orders of the filters are read off these at most 32 counts a part.

A hot text never meets in one task: the first doc_id of a text comes from a partial aggregate
over its SHA-256, and is joined back on (digest, doc_id).  Labels meet documents that were
counted by (doc_id, part, mask) before.

Defined cases: a null text is the empty text; a null part is the empty string; rows without
doc_id never fail E, make no other row fail it and have no labels; repeated rows count as often as
they occur and do not fail E for one another; a doc_id has a label when any of its label rows has;
labels that are null or of absent documents do not count; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import IS_SPACE, splitmix, text_slices, write_table

FILTERS = "ABCDE"
MARKS = b"#$%&*|"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 50, 65, 5
#: Text bytes that one pass of the transducer works on.  A longer text is passed in pieces.
PASS_BYTES = 1 << 18

# byte classes
SPACE, LETTER, CAPITAL, MARK, LEAD, CONTINUATION = range(6)
CLASS = np.full(256, LETTER, np.uint8)
CLASS[IS_SPACE] = SPACE
CLASS[65:91] = CAPITAL
CLASS[list(MARKS)] = MARK
CLASS[128:192] = CONTINUATION
CLASS[192:] = LEAD
# states: outside a word, inside a word
NEXT = np.array([0, 1, 1, 1, 1, 1], np.uint8)  # the class alone decides, so states come from one table lookup
# what a step gives out, as bits
CODE_POINT, IS_CAPITAL, IS_MARK, WORD_START, WORD_END = 1, 2, 4, 8, 16
EMIT = np.zeros((2, 6), np.uint8)
EMIT[:, [SPACE, LETTER, CAPITAL, MARK, LEAD]] |= CODE_POINT
EMIT[:, CAPITAL] |= IS_CAPITAL
EMIT[:, MARK] |= IS_MARK
EMIT[0, 1:] |= WORD_START
EMIT[1, SPACE] |= WORD_END


class Pass:
    """One transducer pass over a run of texts: ``words``, ``capitals``, ``chars``, ``marks`` by text,
    and the spans ``start``/``end`` of all words, those of text i being ``first[i]:first[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        # one closing space after each text ends its last word
        n = len(offsets) - 1
        closed = np.insert(CLASS[data], offsets[1:], SPACE) if n else np.zeros(0, np.uint8)
        state = NEXT[closed]
        before = np.zeros_like(state)
        before[1:] = state[:-1]
        out = EMIT[before, closed]
        at = offsets + np.arange(n + 1)
        count = lambda bit: np.diff(np.concatenate([[0], np.cumsum((out & bit) != 0, dtype=np.int32)])[at])
        self.chars = count(CODE_POINT) - 1  # the closing space
        self.capitals, self.marks = count(IS_CAPITAL), count(IS_MARK)
        start, end = np.flatnonzero(out & WORD_START), np.flatnonzero(out & WORD_END)
        self.first = np.searchsorted(start, at)
        self.words = np.diff(self.first)
        owner = np.repeat(np.arange(n, dtype=np.int64), self.words)
        self.owner, self.start, self.end = owner.astype(np.int32), start - owner, end - owner

    def bytes_of(self, rows: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Byte positions of the words ``rows``, one after the other."""
        total = np.cumsum(length)
        return np.arange(total[-1] if len(total) else 0) + np.repeat(self.start[rows] - (total - length), length)

    def owners(self) -> np.ndarray:
        """For every word the first inserted word of its text with the same bytes: a verified hash table."""
        n = len(self.start)
        if not n:
            return np.zeros(0, np.int64)
        length = self.end - self.start
        everyone = np.arange(n)
        place = self.bytes_of(everyone, length)
        bounds = np.cumsum(length) - length
        with np.errstate(over="ignore"):
            weight = splitmix(int(length.max()), 77)[np.arange(len(place)) - np.repeat(bounds, length)]
            key = np.add.reduceat((self.data[place].astype(np.uint64) + np.uint64(1)) * weight, bounds)
            key ^= (self.owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            key *= np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(29)
        size = 1 << max(4, int(2 * n - 1).bit_length())
        table, mine = np.full(size, -1, np.int64), np.full(n, -1, np.int64)
        slot = (key & np.uint64(size - 1)).astype(np.int64)
        todo = everyone
        while len(todo):
            s = slot[todo]
            free = table[s] < 0
            table[s[free][::-1]] = todo[free][::-1]  # the first of several claims a slot
            held = table[s]
            same = (self.owner[held] == self.owner[todo]) & (length[held] == length[todo])
            near = np.flatnonzero(same & (held != todo))
            if len(near):  # verify the bytes
                size_of = length[todo[near]]
                equal = self.data[self.bytes_of(todo[near], size_of)] == self.data[self.bytes_of(held[near], size_of)]
                same[near] = np.logical_and.reduceat(equal, np.cumsum(size_of) - size_of)
            mine[todo[same]] = held[same]
            todo = todo[~same]
            slot[todo] = (slot[todo] + 1) & (size - 1)
        return mine

    def distinct(self) -> np.ndarray:
        first = self.owners() == np.arange(len(self.start))
        return np.bincount(self.owner[first], minlength=len(self.offsets) - 1)


def _pieces(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text cut after spaces into pieces of at most ``limit`` bytes (more where no space is)."""
    a = 0
    while len(data) - a > limit:
        spaces = np.flatnonzero(IS_SPACE[data[a:a + limit]])
        b = a + limit
        if len(spaces):
            b = a + int(spaces[-1]) + 1
        else:
            while b < len(data):
                later = np.flatnonzero(IS_SPACE[data[b:b + limit]])
                b = b + int(later[0]) + 1 if len(later) else min(len(data), b + limit)
                if len(later):
                    break
        yield data[a:b]
        a = b
    yield data[a:]


def measure(texts: pa.Array, limit: int = PASS_BYTES) -> dict[str, np.ndarray]:
    """words, distinct, capitals, chars, marks of every text (null: empty)."""
    names = ("words", "distinct", "capitals", "chars", "marks")
    parts: list[tuple] = []
    for _, _, data, offsets in text_slices(texts, limit):
        if len(offsets) == 2 and len(data) > limit:  # one long text, its distinct words gathered over pieces
            total, seen = np.zeros(4, np.int64), set()
            for piece in _pieces(data, limit):
                p = Pass(piece, np.array([0, len(piece)]))
                total += [p.words[0], p.capitals[0], p.chars[0], p.marks[0]]
                for i in np.flatnonzero(p.owners() == np.arange(len(p.start))).tolist():
                    seen.add(piece[p.start[i]:p.end[i]].tobytes())
            parts.append(tuple(np.array([v]) for v in (total[0], len(seen), *total[1:])))
        else:
            p = Pass(data, offsets)
            parts.append((p.words, p.distinct(), p.capitals, p.chars, p.marks))
    cols = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
    return dict(zip(names, cols))


def _measurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, rest... -> rest..., the five numbers."""
    for batch in batches:
        m = measure(batch.column(0))
        rest = batch.schema.names[1:]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(v) for v in m.values()]], [*rest, *m])


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, part, digest (SHA-256 of the text), words, distinct, capitals, chars, marks of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    return rows.mapInArrow(_measurer, "doc_id long, part string, digest binary, words long, distinct long, capitals long, chars long, marks long")


def masks(documents: DataFrame) -> DataFrame:
    """doc_id, part, mask, n: how many rows fail exactly the filters of ``mask`` (bit 0 is A)."""
    fails = [F.col("words") < MIN_WORDS, 100 * F.col("distinct") < MIN_DISTINCT_PERCENT * F.col("words"),
             100 * F.col("capitals") > MAX_CAPITAL_PERCENT * F.col("chars"), F.col("marks") > 0]
    own = sum(f.cast("int") * (1 << i) for i, f in enumerate(fails))
    rows = measured(documents).select("doc_id", "part", "digest", own.alias("own"))
    # the one pass over the texts; everything after it reads these short rows
    rows = write_table(rows.groupBy("digest", "doc_id", "part", "own").agg(F.count("*").alias("n")), "filter-rows")
    known = rows.filter("doc_id IS NOT NULL")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    copy = F.col("is_first").isNull().cast("int") * (1 << FILTERS.index("E"))
    with_id = known.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("own") + copy).alias("mask"), "n")
    without = rows.filter("doc_id IS NULL").select("doc_id", "part", F.col("own").alias("mask"), "n")
    return with_id.unionByName(without).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def _orders(letters: str) -> list[str]:
    return ["".join(p) for p in itertools.permutations(letters)]


def audit(documents: DataFrame, labels: DataFrame, letters: Sequence[str] = FILTERS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    letters = "".join(letters)
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
                  F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")).filter("good + toxic > 0"))
    counted = masks(documents)
    marked = (counted.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").select("part", "mask", "n", "good", "toxic")
              .unionByName(counted.filter("doc_id IS NULL").select("part", "mask", "n", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))))
    lost = lambda c: F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).alias(c)
    by_mask = marked.groupBy("part", "mask").agg(F.sum("n").alias("n"), lost("good"), lost("toxic"))
    used = sum(1 << FILTERS.index(c) for c in letters)
    bits = F.col("mask").bitwiseAND(used).alias("mask")
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct(bits, "n", "good", "toxic")).alias("bins"))  # at most 32 a part
    orders = _orders(letters)
    steps = (parts.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in orders])))
             .withColumn("step", F.explode(F.array(*[F.lit(i) for i in range(1, len(letters) + 1)]))))
    # the letter of the step is bit ascii - 65; the letters before it are the mask of earlier filters
    bit = lambda letter: f"shiftleft(1, ascii({letter}) - {ord('A')})"
    steps = (steps.withColumn("bit", F.expr(bit("substring(filter_order, step, 1)")))
             .withColumn("before", F.expr(f"aggregate(split(substring(filter_order, 1, step - 1), ''), 0, (s, c) -> s + if(c = '', 0, {bit('c')}))")))

    def total(condition: str, value: str = "b.n") -> str:
        return f"aggregate(filter(bins, b -> {condition}), 0L, (s, b) -> s + {value})"

    here, earlier = "b.mask & bit != 0", "b.mask & before"
    # each filter of a mask comes first in the same share of all orders
    share = f"b.n * (CAST({len(orders)} AS BIGINT) DIV bit_count(b.mask))"
    return steps.select("part", "filter_order", F.col("step").cast("int").alias("step"),
                        F.expr(total(f"({earlier}) = 0 AND b.mask & bit = 0")).alias("kept"),
                        F.expr(total(f"({earlier}) = 0 AND {here}")).alias("removed"),
                        F.expr(total(f"({earlier}) != 0 AND {here}")).alias("redundant"),
                        F.expr(total("b.mask = bit")).alias("unique_fails"),
                        F.expr(total(f"({earlier}) = 0 AND {here}", "b.good")).alias("good_lost"),
                        F.expr(total(f"({earlier}) = 0 AND {here}", "b.toxic")).alias("toxic_lost"),
                        F.expr(total(here, share)).alias("shapley"))


#: DuckDB SQL of ``audit`` over documents and labels.
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals FROM d),
firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
l AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
  FROM labels GROUP BY doc_id),
m AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         MAP {{'A': len(words) < {MIN_WORDS}, 'B': 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words),
              'C': 100 * capitals > {MAX_CAPITAL_PERCENT} * length(w.text), 'D': regexp_matches(w.text, '[#$%&*|]'),
              'E': w.doc_id IS NOT NULL AND coalesce(f.first < w.doc_id, false)}} AS fails
  FROM w JOIN firsts f ON w.text = f.text LEFT JOIN l ON w.doc_id = l.doc_id),
b AS (
  SELECT part, [x for x in ['A', 'B', 'C', 'D', 'E'] if fails[x]] AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM m GROUP BY 1, 2),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS here, string_split(substr(filter_order, 1, step - 1), '') AS earlier
  FROM o, range(1, 6) AS r(step)),
g AS (
  SELECT b.part, s.filter_order, s.step::INT AS step, s.here,
         coalesce(sum(n) FILTER (NOT list_has_any(mask, earlier) AND NOT list_contains(mask, here)), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT list_has_any(mask, earlier) AND list_contains(mask, here)), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (list_has_any(mask, earlier) AND list_contains(mask, here)), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = [here]), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT list_has_any(mask, earlier) AND list_contains(mask, here)), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (NOT list_has_any(mask, earlier) AND list_contains(mask, here)), 0)::BIGINT AS toxic_lost
  FROM b, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, here)::BIGINT AS shapley
FROM g"""
assert FILTERS == string.ascii_uppercase[:len(FILTERS)]
