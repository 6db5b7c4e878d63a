"""Conversation structure repair by Four-Russians block tables.

The rows of a conversation become symbols (initial s, u, a or other, whole or truncated, or a row
that must go).  Edits cost: keep 0, give the role user or assistant 1, delete 2, insert an empty
user or assistant row 5; a truncated row that stays costs 5 more.  The role initials of the result
are empty or an optional s followed by one or more ua.  Four states tell how far a prefix has come, so the cheapest
completion is a vector of four costs; without their minimum only a handful of such vectors exist.
``Tables`` lists them and, for every block of ``BLOCK`` symbols, the vector on its left for each vector on its
right and what it adds.  A conversation is processed from its end by one lookup a block; then blocks are
expanded backward one by one (the vectors inside, right to left), and their edits are read left to right, the
ASCII-least initial among those that stay cheapest, which gives the least of all cheapest edit strings.

Rows are range-partitioned and sorted by conversation, turn, role and text, so that a conversation of any length is
dealt over tasks.  A conversation inside one range that is no longer than a piece is finished there.  Others are
cut into pieces that carry their map of vectors (Four-Russians again); pieces are chained once from
the right (vectors), once from the left (states), by short rows that hold no text, and each piece is then traced by itself.

Defined cases: a null role, text, conv_id or turn reads as one space in ``damage``'s draw, and a null role or text is one space from
there on; rows without conv_id form one conversation; rows go by turn (nulls first), then role, then text, in code point
order; repeated rows all count, next to one another; an empty role has no initial a result may have, so such a row is reroled or
deleted; a conversation that loses all rows has zeros, an empty audit and no repaired rows; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import WHITESPACE, drop_table, shuffle_partitions, write_table

# --- block tables ---------------------------------------------------------------------------

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Symbols: 2 * (s, u, a, other) + truncated, and the row that must go.
GONE, SYMBOLS = 8, 9
BLOCK = 4
FAR = 1 << 20
# states: nothing yet, s, ... u, ... ua; where an initial leads (s 0, u 1, a 2; None: not allowed)
STEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
#: The one role that a rerole or an insert can give in a state.
NAMED = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))


def _closed(v: list[int]) -> list[int]:
    """Costs with inserts before the next row."""
    for _ in range(3):
        v = [min(c, INSERT + v[NAMED[q][0]]) for q, c in enumerate(v)]
    return v


def _before(v: tuple[int, ...], symbol: int) -> list[int]:
    """Costs to go on the left of ``symbol`` when ``v`` are those on its right."""
    initial, cut = symbol >> 1, TRUNCATED * (symbol & 1)
    out = []
    for q in range(4):
        best = DELETE + v[q]
        if symbol != GONE:
            best = min(best, REROLE + cut + v[NAMED[q][0]])
            if initial in STEP[q]:
                best = min(best, KEEP + cut + v[STEP[q][initial]])
        out.append(best)
    return _closed(out)


class Tables:
    """All normalised vectors, and the vector and the added cost on the left of every block."""

    def __init__(self):
        def norm(v):
            low = min(v)
            return tuple(c - low for c in v), low

        self.end, self.end_cost = 0, 0  # an end is free in states 0 and 3, which are the least
        self.vectors = [norm(_closed([0, FAR, FAR, 0]))[0]]
        place, rows, adds = {self.vectors[0]: 0}, [], []
        for v in self.vectors:  # grows while it is read
            got = [norm(_before(v, s)) for s in range(SYMBOLS)]
            for w, _ in got:
                if w not in place:
                    place[w] = len(self.vectors)
                    self.vectors.append(w)
            rows.append([place[w] for w, _ in got])
            adds.append([c for _, c in got])
        self.one, self.one_cost = np.array(rows, np.int16), np.array(adds, np.int32)
        # the blocks are numbered by their symbols left to right; one more symbol on the left at a time
        to, cost = self.one, self.one_cost
        for n in range(1, BLOCK):
            number = np.arange(SYMBOLS ** (n + 1))
            left, rest = number // SYMBOLS ** n, number % SYMBOLS ** n
            cost = cost[:, rest] + self.one_cost[to[:, rest], left]
            to = self.one[to[:, rest], left]
        self.to, self.cost = to, cost
        self.power = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The short head of a row of symbols, and the numbers of the full blocks after it."""
        head = len(symbols) % BLOCK
        return symbols[:head], symbols[head:].reshape(-1, BLOCK) @ self.power

    def left_of(self, symbols: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors on the left and costs added, for vectors on the right (any number at once)."""
        head, blocks = self.blocks(symbols)
        cost = np.zeros(len(right), np.int64)
        for b in blocks[::-1].tolist():
            cost += self.cost[right, b]
            right = self.to[right, b]
        for s in head[::-1].tolist():
            cost += self.one_cost[right, s]
            right = self.one[right, s]
        return right, cost

    def trace(self, symbols: np.ndarray, right: int, state: int) -> tuple[str, int]:
        """The least of the cheapest edit strings from ``state`` on the left, and the state on the right."""
        head, blocks = self.blocks(symbols)
        rights, v = [], right
        for b in blocks[::-1].tolist():
            rights.append(v)
            v = int(self.to[v, b])
        out = []
        if len(head):
            edits, state = self.expand(tuple(head.tolist()), v, state)
            out.append(edits)
        for b, v in zip(blocks.tolist(), rights[::-1]):
            edits, state = self.expand(tuple((b // self.power % SYMBOLS).tolist()), v, state)
            out.append(edits)
        return "".join(out), state

    @functools.lru_cache(maxsize=1 << 16)  # noqa: B019
    def expand(self, symbols: tuple[int, ...], right: int, state: int) -> tuple[str, int]:
        inside, added = [right], []
        for s in reversed(symbols):
            added.append(int(self.one_cost[inside[-1], s]))
            inside.append(int(self.one[inside[-1], s]))
        inside.reverse()
        added.reverse()
        out = []
        for i, s in enumerate(symbols):
            here, after = self.vectors[inside[i]], [c - added[i] for c in self.vectors[inside[i + 1]]]
            while True:
                best, cut, named = here[state], TRUNCATED * (s & 1), NAMED[state][0]
                if best == DELETE + after[state]:
                    out.append("D")
                elif best == INSERT + here[named]:
                    out.append("I")
                    state = named
                    continue
                elif s != GONE and s >> 1 in STEP[state] and best == KEEP + cut + after[STEP[state][s >> 1]]:
                    out.append("K")
                    state = STEP[state][s >> 1]
                else:
                    out.append("R")
                    state = named
                break
        return "".join(out), state

    def close(self, state: int) -> tuple[str, int]:
        """Inserts after the last row."""
        out = ""
        while state in (1, 2):
            out, state = out + "I", NAMED[state][0]
        return out, state


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """The rows that ``edits`` leave of the rows, read from ``state``."""
    out, i = [], 0
    for e in edits:
        if e == "I":
            out.append((NAMED[state][1], ""))
            state = NAMED[state][0]
            continue
        if e == "K":
            out.append((roles[i], texts[i]))
            state = STEP[state]["sua".index(roles[i][0])]
        elif e == "R":
            out.append((NAMED[state][1], texts[i]))
            state = NAMED[state][0]
        i += 1
    return out


# --- rows -----------------------------------------------------------------------------------

#: A piece ends after so many rows or characters of text.
PIECE_ROWS, PIECE_CHARS = 8192, 4 << 20


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: the rows after the seeded damage, n times each (0: dropped)."""
    space = F.lit(" ")
    id_, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    kind = F.crc32(F.concat(F.coalesce(id_, space), F.lit(":"), F.coalesce(turn, space)).cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 0, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                       F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


def _symbol(role: Column, blank: Column, duplicate: Column, cut: Column) -> Column:
    first = F.substring(role, 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return F.when(blank | duplicate, GONE).otherwise(2 * initial + cut.cast("int")).cast("int")


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, n) with their first fault: blank, duplicate (of a row of an
    earlier turn; further copies of a row are duplicates anyway), truncated, and the symbol."""
    one = write_table(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")), "conversation-rows")
    blank = ~F.col("text").rlike(f"[^{WHITESPACE}]")
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    # role and text that come in several turns of a conversation: their first turn, from partial aggregates
    again = (one.filter((F.col("n") > 0) & ~blank).groupBy("conv_id", "role", digest.alias("digest"))
             .agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.max(F.col("turn").isNull()).alias("at_null"))
             .filter("first_turn < last_turn OR at_null AND first_turn IS NOT NULL").drop("last_turn"))
    l, r = one.withColumn("digest", digest).alias("l"), again.alias("r")
    met = l.join(r, F.expr("l.conv_id <=> r.conv_id AND l.role = r.role AND l.digest = r.digest AND l.n > 0"), "left")
    later = F.coalesce(F.col("l.turn").isNotNull() & (F.col("r.at_null") | (F.col("l.turn") > F.col("r.first_turn"))), F.lit(False))
    out = met.select("l.conv_id", "l.turn", "l.role", "l.text", "l.n", later.alias("later")).withColumn("blank", blank)
    cut = ~F.col("text").rlike(f"[.!?][{WHITESPACE}]*\\z")
    return (out.withColumn("duplicate", F.col("later") & ~F.col("blank")).withColumn("truncated", cut & ~F.col("blank") & ~F.col("later"))
            .withColumn("symbol", _symbol(F.col("role"), F.col("blank"), F.col("later"), cut)).drop("later"))


_SUMS = ["rows", "distinct_turns", "blank", "duplicate", "truncated", "illegal", "cost"]
_PIECE = ("conv_id {id}, part int, seq int, whole boolean, rows long, min_turn long, max_turn long, distinct_turns long, blank long, duplicate long, "
          "truncated long, illegal long, cost long, first_initial string, last_initial string, audit string, repaired array<struct<role:string,text:string>>, "
          "symbols binary, extra array<long>, roles array<string>, texts array<string>, to binary, added binary")


class _Piece:
    """Successive rows of one conversation."""

    def __init__(self, conv, seq: int):
        self.conv, self.seq, self.chars = conv, seq, 0
        self.symbols, self.extra, self.roles, self.texts, self.turns = [], [], [], [], []
        self.count = dict.fromkeys(_SUMS, 0)

    def add(self, turn, role, text, n, symbol, blank, duplicate, truncated) -> None:
        c = self.count
        if n <= 0:  # a dropped row only names its conversation
            return
        initial = role[:1]
        if self.roles and self.roles[-1][:1] + initial not in ("su", "ua", "au"):
            c["illegal"] += 1
        c["illegal"] += n - 1
        c["rows"] += n
        c["blank"] += n if blank else 0
        c["duplicate"] += n if duplicate else 0 if blank else n - 1
        c["truncated"] += truncated
        if turn is not None:
            c["distinct_turns"] += not self.turns or self.turns[-1] != turn
            self.turns = [self.turns[0] if self.turns else turn, turn]
        self.symbols.append(symbol)
        self.extra.append(n - 1)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def row(self, part: int, whole: bool) -> list:
        t = tables()
        symbols, none = np.array(self.symbols, np.int64), None
        low, high = self.turns if self.turns else (None, None)
        ends = [self.roles[0][:1], self.roles[-1][:1]] if self.roles else [None, None]
        head = lambda: [self.conv, part, self.seq, whole, *[self.count[k] for k in _SUMS[:1]], low, high, *[self.count[k] for k in _SUMS[1:]], *ends]
        self.count["cost"] = DELETE * sum(self.extra)
        if not whole:
            to, added = t.left_of(symbols, np.arange(len(t.vectors)))
            return [*head(), none, none, bytes(self.symbols), self.extra, self.roles, self.texts, to.astype(np.int16).tobytes(), added.tobytes()]
        v, added = t.left_of(symbols, np.array([t.end]))
        self.count["cost"] += int(added[0]) + t.vectors[int(v[0])][0]
        edits, state = t.trace(symbols, t.end, 0)
        edits += t.close(state)[0]
        kept = [{"role": r, "text": x} for r, x in apply_edits(edits, 0, self.roles, self.texts)]
        return [*head(), with_extra(edits, self.extra), kept, none, none, none, none, none, none]


def with_extra(edits: str, extra: list[int]) -> str:
    """The edits of distinct rows with one more deletion for every further copy of a row."""
    if not any(extra):
        return edits
    out, i = [], 0
    for e in edits:
        out.append(e)
        if e != "I":
            out.append("D" * extra[i])
            i += 1
    return "".join(out)


def _cutter(schema: pa.Schema, piece_rows: int):
    """Pieces of sorted rows.  A conversation that touches an edge of its range may go on beyond it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        out: list[list] = []
        piece, first, size = None, True, 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for b in batches:
            for conv, *values in zip(*[c.to_pylist() for c in b.columns]):
                if piece is None:
                    piece = _Piece(conv, 0)
                elif conv != piece.conv:
                    out.append(piece.row(part, not first and piece.seq == 0))
                    size += piece.chars
                    piece, first = _Piece(conv, 0), False
                elif len(piece.symbols) >= piece_rows or piece.chars >= PIECE_CHARS:
                    out.append(piece.row(part, False))
                    size += piece.chars
                    piece = _Piece(conv, piece.seq + 1)
                piece.add(*values)
                if len(out) >= 4096 or size >= PIECE_CHARS:
                    yield batch()
                    out, size = [], 0
        if piece is not None:
            out.append(piece.row(part, False))
        if out:
            yield batch()
    return run


def _chain_right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted from the last piece to the first: the vector on the right of every piece."""
    t, conv, v = tables(), (), 0
    for b in batches:
        out = []
        for c, to in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
            if (c,) != conv:
                conv, v = (c,), t.end
            out.append(v)
            v = int(np.frombuffer(to, np.int16)[v])
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.int32())], ["conv_id", "part", "seq", "right"])


def _tracer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, part, seq, and by entry state the edits of a piece and the state after it."""
    t = tables()
    for b in batches:
        rows = [[t.trace(np.frombuffer(s, np.uint8).astype(np.int64), v, q) for q in range(4)] for s, v in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([[e for e, _ in r] for r in rows], pa.list_(pa.string())),
                                          pa.array([[q for _, q in r] for r in rows], pa.list_(pa.int32()))], ["conv_id", "part", "seq", "edits", "after"])


def _chain_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted from the first piece to the last: the state on the left of every piece."""
    conv, q = (), 0
    for b in batches:
        out = []
        for c, after in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
            if (c,) != conv:
                conv, q = (c,), 0
            out.append(q)
            q = after[q]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.int32())], ["conv_id", "part", "seq", "state"])


def _finisher(schema: pa.Schema):
    """Audit and repaired rows of every piece (those of the last piece with the closing inserts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables()
        for b in batches:
            cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            audit, repaired, added = [], [], []
            for i in range(len(b)):
                q, edits = cols["state"][i], cols["edits"][i][cols["state"][i]]
                if cols["last"][i]:
                    edits += t.close(cols["after"][i][q])[0]
                v = cols["right"][i]
                cost = int(np.frombuffer(cols["added"][i], np.int64)[v])
                if cols["leftmost"][i]:
                    cost += t.vectors[int(np.frombuffer(cols["to"][i], np.int16)[v])][0]
                added.append(cols["cost"][i] + cost)
                audit.append(with_extra(edits, cols["extra"][i]))
                repaired.append([{"role": r, "text": x} for r, x in apply_edits(edits, q, cols["roles"][i], cols["texts"][i])])
            own = {"audit": audit, "repaired": repaired, "cost": added}
            yield pa.RecordBatch.from_arrays([pa.array(own.get(f.name, cols.get(f.name)), f.type) for f in schema], schema=schema)
    return run


_KEEP = ["conv_id", "part", "seq", "rows", "min_turn", "max_turn", "distinct_turns", "blank", "duplicate", "truncated", "illegal", "cost",
         "first_initial", "last_initial", "audit", "repaired"]


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Repaired pieces of conversations in order (conv_id, part, seq) from rows (conv_id, turn, role, text, n), n being
    how often a row occurs (0: not at all, the conversation is still reported): counts, audit, repaired rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = rows.sparkSession
    marked = write_table(faults(rows), "conversation-faults")
    by = ["conv_id", "turn", "role", "text"]
    cols = [*by, "n", "symbol", "blank", "duplicate", "truncated"]
    ranged = marked.select(*cols).repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by)
    kind = marked.schema["conv_id"].dataType.simpleString()
    ddl = _PIECE.format(id=kind)
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    pieces = write_table(ranged.mapInArrow(_cutter(schema, piece_rows), ddl), "conversation-pieces")
    key = ["conv_id", "part", "seq"]
    whole, cut = pieces.filter("whole").select(*_KEEP), pieces.filter("NOT whole")
    n = shuffle_partitions(spark)

    def chained(df: DataFrame, run, out: str, back: bool) -> DataFrame:
        order = ["conv_id", *[F.desc(c) if back else F.asc(c) for c in key[1:]]]
        return df.repartition(n, "conv_id").sortWithinPartitions(*order).mapInArrow(run, f"conv_id {kind}, part int, seq int, {out}")

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnsRenamed({c: f"_{c}" for c in key})
        on = F.lit(True)
        for c in key:
            on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return a.join(b, on).drop(*[f"_{c}" for c in key])

    rights = write_table(chained(cut.select(*key, "to"), _chain_right, "right int", True), "conversation-rights")
    traced = write_table(meet(cut.select(*key, "symbols"), rights).select(*key, "symbols", "right")
                         .mapInArrow(_tracer, f"conv_id {kind}, part int, seq int, edits array<string>, after array<int>"), "conversation-traces")
    states = write_table(chained(traced.select(*key, "after"), _chain_left, "state int", False), "conversation-states")
    ends = cut.groupBy("conv_id").agg(F.min(F.struct("part", "seq")).alias("lo"), F.max(F.struct("part", "seq")).alias("hi"))
    here = F.struct("part", "seq")
    first_last = (cut.select(*key).join(ends.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")))
                  .select(*key, (here == F.col("lo")).alias("leftmost"), (here == F.col("hi")).alias("last")))
    full = meet(meet(meet(meet(cut.drop("audit", "repaired", "symbols"), rights), traced), states), first_last)
    done = full.mapInArrow(_finisher(to_arrow_schema(whole.schema)), whole.schema)
    out = write_table(whole.unionByName(done), "conversation-repaired")
    for table in (marked, pieces, rights, traced, states):
        drop_table(table)
    return out


# --- the report -----------------------------------------------------------------------------

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the repaired rows of each conversation, from its pieces in order; holds one batch."""
    conv, sha, empty = (), None, True

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv[0]], kind), pa.array([sha.hexdigest()])], ["conv_id", "repaired_sha256"])

    for b in batches:
        kind = b.column(0).type
        for c, repaired in zip(b.column(0).to_pylist(), b.column(3)):
            if (c,) != conv:
                if conv:
                    yield out()
                conv, sha, empty = (c,), hashlib.sha256(), True
            for r in repaired.values or []:
                sha.update((("" if empty else "\n") + r["role"].as_py() + ":" + r["text"].as_py()).encode())
                empty = False
    if conv:
        yield out()


def report(pieces: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    A conversation of one piece is digested where it stands.  The digest of a longer one is one chain over its
    text by definition, so its pieces pass one task in order, a batch at a time.
    """
    spark = pieces.sparkSession
    w = Window.partitionBy("conv_id").orderBy("part", "seq")
    short = ["rows", "min_turn", "max_turn", "distinct_turns", "blank", "duplicate", "truncated", "illegal", "cost", "first_initial", "last_initial"]
    counts = pieces.groupBy("conv_id").agg(F.count("*").alias("pieces"))
    many = counts.filter("pieces > 1").select(F.col("conv_id").alias("_c"))
    inner = F.col("conv_id").eqNullSafe(F.col("_c"))
    long_ones = pieces.join(many, inner, "left_semi")
    line = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    gaps = lambda low, high, distinct: F.coalesce(F.col(high) - F.col(low) + 1 - F.col(distinct), F.lit(0)).cast("long").alias("gaps")
    totals = ["blank", "duplicate", "truncated", "illegal", "cost"]
    single = (pieces.select("conv_id", gaps("min_turn", "max_turn", "distinct_turns"), *totals, "audit",
                            F.sha2(F.array_join(line, "\n").cast("binary"), 256).alias("repaired_sha256"))
              .join(many, inner, "left_anti"))
    # pieces without rows carry nothing over; the seams between the others are told by their neighbours
    real = long_ones.select("conv_id", "part", "seq", *short).filter("rows > 0")
    seams = (real.withColumn("_before", F.lag("last_initial").over(w))
             .withColumn("_turn", F.last("max_turn", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("illegal", F.col("illegal") + (F.col("_before").isNotNull() & ~F.concat("_before", "first_initial").isin("su", "ua", "au")).cast("long"))
             .withColumn("distinct_turns", F.col("distinct_turns") - F.coalesce(F.col("_turn") == F.col("min_turn"), F.lit(False)).cast("long")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    sums = (seams.groupBy("conv_id").agg(F.min("min_turn").alias("low"), F.max("max_turn").alias("high"), F.sum("distinct_turns").alias("turns"),
                                         *[F.sum(c).alias(c) for c in totals if c != "cost"]))
    costs = (long_ones.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("part", "seq", "audit"))).alias("a"))
             .select(F.col("conv_id").alias("_k"), "cost", F.array_join("a.audit", "").alias("audit")))
    kind = pieces.schema["conv_id"].dataType.simpleString()
    digests = (long_ones.select("conv_id", "part", "seq", "repaired").repartition(shuffle_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "part", "seq")
               .mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string").withColumnRenamed("conv_id", "_d"))
    joined = (costs.join(sums, F.col("_k").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("_k").eqNullSafe(F.col("_d"))))
    multi = joined.select(F.col("_k").alias("conv_id"), gaps("low", "high", "turns"), *[zero(c) for c in totals], "audit", "repaired_sha256")
    return single.unionByName(multi)
