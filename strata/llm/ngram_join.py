"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document is the set of its distinct word shingles, and links with documents of Jaccard
similarity ``percent`` / 100 or more: with n shingles it needs an overlap of at least T =
ceil(n * percent / 100).  Of a document's inverted lists the T - 1 longest are put aside;
a partner must then occur on one of the short ones.  Only postings of the short lists are
built.  They are merged by sorting over ranges of (shingle, set size, document), so a
frequent shingle spans many tasks; candidates are probed against the remaining shingles by
binary search in the partner's sorted set, and those that reach the overlap are links.

List lengths come from a count of the shingles that are frequent somewhere in the corpus
(at most ``HOT``, which bounds what is sent to the tasks); they only decide the order in
which lists count as long, any common order gives the same links.

Equal sets are one class.  The result wants components, not pairs: a first pass checks
each posting against its two predecessors and the first of its list, then the largest component of each
list against the others on it.  The second pass takes lists that still hold several components in blocks of
``BLOCK`` postings: inside blocks, then members outside the largest component across blocks.  Parity bitmaps bound the
overlap from above; members with a possible partner travel once, as groups, and are verified with their sets in one
task that joins components as it goes, so a group gives fewer links than it has members.

Words are runs without ASCII white space, A-Z lowered.  Defined cases: a document with fewer words
than ``k`` has its whole sequence as one shingle; null, empty and blank texts have the empty set
and link with nothing; rows without doc_id link with nothing and have a null component; rows that
share a doc_id are one document, linked through any of its texts; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Words, _mix, components, drop_table, shuffle_partitions, splitmix, text_slices, write_table

#: Most frequent shingles whose counts order the lists (8 + 8 bytes each).
HOT = 1 << 16
#: Postings of one list, and shingles of their documents, in one block; two blocks meet in a task.
BLOCK = 512
SHINGLES = 1 << 20
BITS = 1024
#: Rounds that check the largest component of each list against the rest; they only save work later.
HEAD_ROUNDS = 1
#: Document ids up to which they are broadcast to pick texts; beyond it the texts are shuffled.
SMALL = 1 << 20
#: Text bytes shingled in one step: word arrays take some 80 bytes for each of them.
SLICE = 1 << 18


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for a, _, data, offsets in text_slices(texts, SLICE):
        h, bounds = Words(data, offsets, lower=True).shingles(k)
        for i, (x, y) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
            yield a + i, np.unique(h[x:y])


def _frequent(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of shingles found in three documents of some slice of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some: list[np.ndarray] = []
            size = 0
            for i, s in _sets(batch.column(0), k):
                some.append(s)
                size += len(s)
                if size > 1 << 21 or i + 1 == len(batch):
                    h, n = np.unique(np.concatenate(some), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h[n > 2].view(np.int64)), pa.array(n[n > 2])], ["h", "n"])
                    some, size = [], 0

    top = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(HOT)
    rows = top.toArrow()  # at most HOT rows
    h = rows.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], rows.column("n").to_numpy()[order]


def _bitmap(s: np.ndarray) -> np.ndarray:
    """Parity of the set's shingles by slot; longer for large sets, a longer one folds onto a shorter."""
    bits = BITS
    while bits < len(s) // 2:
        bits *= 2
    count = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).view(np.uint64)


def _fold(b: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(b.reshape(-1, words), axis=0)


def _outline(docs: DataFrame, k: int, percent: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per row: doc_id, n, two hashes of the set, its bitmap, and the shingles of its short lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = hot
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for i, s in _sets(batch.column(1), k):
                n = len(s)
                with np.errstate(over="ignore"):
                    m = splitmix(n, 11)
                    whole = [int(x) for x in np.array([(s * (m | np.uint64(1))).sum(), _mix(s ^ m).sum()], np.uint64).view(np.int64)]
                weight = np.zeros(n, np.int64)
                if len(hashes) and n:
                    at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                    weight = np.where(hashes[at] == s, counts[at], 0)
                short = s[np.lexsort((s, weight))][:n - (percent * n + 99) // 100 + 1] if n else s
                rows.append((ids[i], n, *whole, _bitmap(s).tobytes(), short.view(np.int64)))
                if len(rows) == 1024 or i + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([r[c] for r in rows], pa.int64()) for c in range(4)), pa.array([r[4] for r in rows], pa.binary()),
                         pa.array([r[5] for r in rows], pa.list_(pa.int64()))], ["doc_id", "n", "h1", "h2", "bitmap", "short"])
                    rows = []

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n long, h1 long, h2 long, bitmap binary, short array<long>"))


def _merged(percent: int):
    """Of sorted (key, n, doc) postings those with a neighbour on their list whose size allows a link
    (sorted by size, a posting without one has no partner there), with the sizes' nearest documents: the two
    before on the list and the list's first one.  The first and the last list of a range may go on in
    another one and stay."""
    names = ["key", "n", "doc", "p1", "p2", "p3"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        first = None
        lead_n = lead_doc = 0  # of the list that goes on
        for batch in batches:
            key, n, doc = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(key):
                continue
            first = key[0] if first is None else first
            skip = 0
            if held is not None:
                key, n, doc = (np.concatenate(x) for x in zip(held, (key, n, doc)))
                skip = len(held[0]) - 1  # rows decided with the batch before
            same = np.append(False, key[1:] == key[:-1])
            two = np.append([False, False], key[2:] == key[:-2])[:len(key)]
            begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
            n0, doc0 = n[begin], doc[begin]
            if held is not None:
                on = begin == 0  # the list of the first held row began before
                n0, doc0 = np.where(on, lead_n, n0), np.where(on, lead_doc, doc0)
            lead_n, lead_doc = n0[max(0, len(key) - 3)], doc0[max(0, len(key) - 3)]
            fits = lambda m: 100 * m >= percent * n
            p1 = same & fits(np.roll(n, 1))
            p2 = two & fits(np.roll(n, 2))
            p3 = same & fits(n0)
            keep = p1 | np.append(p1[1:], False) | (key == first)
            keep[:skip], keep[-1] = False, False
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), pa.array(n[at]), pa.array(doc[at]), pa.array(doc[at - 1], mask=~p1[at]),
                 pa.array(doc[at - 2], mask=~p2[at]), pa.array(doc0[at], mask=~p3[at])], names)
            last = pa.RecordBatch.from_arrays(
                [pa.array(x[-1:]) for x in (key, n, doc)] + [pa.array(np.roll(doc, k)[-1:], mask=~m[-1:]) for k, m in ((1, p1), (2, p2))]
                + [pa.array(doc0[-1:], mask=~p3[-1:])], names)
            held = [x[-3:] for x in (key, n, doc)]
        if held is not None:
            yield last

    return run


def _near(percent: int, n1: np.ndarray, n2: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Whether a link is possible when the sets differ in at least ``apart`` shingles."""
    most = (n1 + n2 - apart) // 2
    return 100 * most >= percent * (n1 + n2 - most)


def _possible(percent: int):
    """Pairs (a, b) with their sizes and bitmaps -> those whose bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n1, n2 = (batch.column(c).to_numpy() for c in (2, 3))
            apart = np.zeros(len(batch), np.int64)
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                w = min(len(x), len(y))
                apart[i] = np.bitwise_count(_fold(x, w) ^ _fold(y, w)).sum()
            keep = pa.array(_near(percent, n1, n2, apart))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])
    return run


def _partners(percent: int, n: np.ndarray, doc: np.ndarray, side: np.ndarray, raw: list, label: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each member (ascending by ``n``) the later ones of another label that its bitmap allows to
    link with; ``label`` may be changed by the reader on the way.  Members of one side (1 or 2) do not meet."""
    for x in range(len(n)):
        # partners are behind x in size order and at most n / similarity large
        end = int(np.searchsorted(n, n[x] * 100 // percent, side="right"))
        y = np.arange(x + 1, end)
        y = y[(label[y] != label[x]) & ((side[y] != side[x]) | (side[x] == 0)) & (doc[y] != doc[x])]
        if len(y):
            words = min(len(raw[x]), min(len(raw[i]) for i in y.tolist()))
            mine = _fold(raw[x], words)
            theirs = np.array([raw[i] if len(raw[i]) == words else _fold(raw[i], words) for i in y.tolist()])
            y = y[_near(percent, n[x], n[y], np.bitwise_count(theirs ^ mine).sum(axis=1).astype(np.int64))]
            if len(y):
                yield x, y


def _by_group(keys: list[str], one):
    """A function over batches sorted by ``keys`` that gives ``one(group)`` of every whole group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def edges(t: pa.Table) -> np.ndarray:
            moved = np.zeros(max(len(t) - 1, 0), bool)
            for k in keys:
                c = t.column(k).to_numpy()
                moved |= c[1:] != c[:-1]
            return np.flatnonzero(moved) + 1

        def groups(t: pa.Table) -> Iterator[pa.RecordBatch]:
            cut = edges(t).tolist()
            for a, b in zip([0, *cut], [*cut, len(t)]):
                if b - a > 1:
                    yield from one(t.slice(a, b - a))

        for batch in batches:
            if not len(batch):
                continue
            t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            cut = edges(t)
            end = int(cut[-1]) if len(cut) else 0
            if end:
                yield from groups(t.slice(0, end))
            held = t.slice(end)  # the last group may go on in the next batch; it has two blocks of rows at most
        if held is not None:
            yield from groups(held)

    return run


def _candidates(percent: int):
    """Postings of one list that meet -> those with a partner that bitmaps allow, in groups joined by such
    partners.  At most one row a posting; a group that many lists give has one id."""

    def one(t: pa.Table) -> Iterator[pa.RecordBatch]:
        n, doc, comp, part = (t.column(c).to_numpy() for c in ("n", "doc", "comp", "part"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        order = np.lexsort((doc, n))
        n, doc, comp, part = n[order], doc[order], comp[order], part[order]
        bitmaps = t.column("bitmap").to_pylist()
        raw = [np.frombuffer(bitmaps[r], np.uint64) for r in order.tolist()]
        side = np.zeros(len(n), np.int32) if i == j else (1 + (part == j)).astype(np.int32)
        group, found = np.arange(len(n)), np.zeros(len(n), bool)
        for x, y in _partners(percent, n, doc, side, raw, comp):
            found[x] = found[y] = True
            old = np.unique(np.append(group[y], group[x]))
            if len(old) > 1:
                group[np.isin(group, old)] = old[0]
        at = np.flatnonzero(found)
        if len(at):
            with np.errstate(over="ignore"):
                member = _mix(doc[at].view(np.uint64) * np.uint64(3) + side[at].astype(np.uint64))
                total = np.zeros(len(n), np.uint64)
                np.add.at(total, group[at], member)
                gid = _mix(total[group[at]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(gid.view(np.int64)), pa.array(side[at]), pa.array(doc[at]), pa.array(comp[at])], ["gid", "side", "doc", "comp"])

    return _by_group(["key", "i", "j"], one)


def _joined(percent: int):
    """Groups of candidates with their sets -> the links that join their components: fewer than members."""

    def one(t: pa.Table) -> Iterator[pa.RecordBatch]:
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("shingles")]
        n, doc, comp, side = np.array([len(s) for s in sets]), *(t.column(c).to_numpy() for c in ("doc", "comp", "side"))
        order = np.lexsort((doc, n))
        n, doc, label, side = n[order], doc[order], comp[order].copy(), side[order]
        sets = [sets[r] for r in order.tolist()]
        out = []
        for x, y in _partners(percent, n, doc, side, [_bitmap(s) for s in sets], label):
            for z in y.tolist():
                if label[z] != label[x] and _linked(percent, sets[x], sets[z]):
                    out.append((doc[x], doc[z]))
                    label[label == label[z]] = label[x]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in out], pa.int64()) for c in (0, 1)], ["a", "b"])

    return _by_group(["gid"], one)


def _linked(percent: int, x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity: the smaller one is probed in the larger."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _set_table(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, shingles) of the documents in ``ids`` (distinct doc_id)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for i, s in _sets(batch.column(1), k):
                if len(s):
                    rows.append((ids[i], s.tobytes()))
                if len(rows) == 256 or i + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["id", "shingles"])
                    rows = []

    ids = write_table(ids, "ngram-ids")
    if ids.count() <= SMALL:
        ids = F.broadcast(ids)  # checked: 8 bytes each
    return write_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
                       .select("doc_id", "text").mapInArrow(sets, "id long, shingles binary"), "ngram-sets")


def _links(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([_linked(percent, *(np.frombuffer(v.as_buffer(), np.uint64) for v in xy))
                             for xy in zip(batch.column(2), batch.column(3))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    held = _set_table(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), k)
    left, right = held.toDF("a", "x"), held.toDF("b", "y")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(probe, "a long, b long").distinct()


def join_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    n_parts = shuffle_partitions(docs.sparkSession)
    outline = write_table(_outline(docs, k, percent, _frequent(docs, k)), "ngram-outline")
    whole = ["n", "h1", "h2"]
    classes = outline.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*whole).agg(F.min("doc_id").alias("rep"))
    reps = outline.join(classes.withColumnRenamed("rep", "doc_id"), [*whole, "doc_id"], "left_semi").dropDuplicates(["doc_id", *whole])
    sizes = reps.select("doc_id", "n", "bitmap")
    postings = reps.select(F.explode("short").alias("key"), "n", F.col("doc_id").alias("doc"))
    lists = write_table(postings.repartitionByRange(n_parts, "key", "n", "doc").sortWithinPartitions("key", "n", "doc")
                        .mapInArrow(_merged(percent), "key long, n long, doc long, p1 long, p2 long, p3 long"), "ngram-lists")

    def verified(pairs: DataFrame) -> DataFrame:
        """Edges among the pairs (d, p): bitmaps first, then the sets."""
        pairs = pairs.filter("d <> p").select(F.least("d", "p").alias("a"), F.greatest("d", "p").alias("b")).distinct()
        near = write_table(_with_bitmaps(pairs, sizes).mapInArrow(_possible(percent), "a long, b long"), "ngram-pairs")
        return _links(docs, near, k, percent)

    def with_components(comp: DataFrame) -> DataFrame:
        placed = lists.select("key", "n", "doc").join(comp.withColumnRenamed("id", "doc"), "doc", "left")
        return placed.withColumn("comp", F.coalesce("component", "doc")).drop("component")

    def extended(comp: DataFrame, edges: DataFrame) -> DataFrame:
        """Components after more edges: those of the components joined by them."""
        if edges.isEmpty():
            return comp
        of = lambda c: comp.toDF(c, f"{c}_comp")
        between = (edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
                   .select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")))
        merged = write_table(components(between), "ngram-merged").toDF("component", "now")
        moved = comp.join(merged, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
        alone = merged.select(F.col("component").alias("id"), "now").join(comp, "id", "left_anti")
        return write_table(moved.union(alone), "ngram-components")

    # First pass: neighbours on a list, and its first document; then the largest component of a list against the rest.
    edges = write_table(verified(lists.select(F.col("doc").alias("d"), F.explode(F.array("p1", "p2", "p3")).alias("p")).filter("p IS NOT NULL")), "ngram-links")
    comp = write_table(components(edges), "ngram-components")
    for _ in range(HEAD_ROUNDS):
        placed = with_components(comp)
        parts = placed.groupBy("key", "comp").agg(F.count("*").alias("c"), F.min(F.struct("n", "doc")).alias("lead"))
        tops = (parts.groupBy("key").agg(F.max(F.struct("c", "comp", "lead")).alias("top"), F.count("*").alias("parts")).filter("parts > 1")
                .select("key", F.col("top.comp").alias("top"), F.col("top.lead.doc").alias("p"), F.col("top.lead.n").alias("pn")))
        fits = f"100 * least(n, pn) >= {percent} * greatest(n, pn)"
        more = write_table(verified(placed.join(tops, "key").filter("comp <> top").filter(fits).select(F.col("doc").alias("d"), "p")), "ngram-links")
        comp = extended(comp, more)

    def blocks(count: str, shingles: str):
        return F.ceil(F.greatest(F.col(count) / BLOCK, F.col(shingles) / SHINGLES)).cast("int")

    def met(comp: DataFrame, across: bool) -> DataFrame:
        """Postings of lists with several components, once for each block that they meet.  Inside: a list is cut
        into blocks.  Across: the members outside its largest component, in blocks, meet one another and the
        blocks of the largest component, whose members do not meet."""
        placed = with_components(comp)
        parts = placed.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
        whole = (parts.groupBy("key").agg(F.max(F.struct("c", "comp", "s")).alias("top"), F.sum("c").alias("members"), F.sum("s").alias("size"),
                                          F.count("*").alias("parts"))
                 .filter("parts > 1").withColumn("all", blocks("members", "size")))
        if across:
            whole = (whole.filter("`all` > 1").selectExpr("key", "top.comp AS top", "top.c AS tc", "top.s AS ts", "members - top.c AS oc", "size - top.s AS os")
                     .withColumn("low", blocks("tc", "ts")).withColumn("high", blocks("oc", "os")).select("key", "top", "low", "high"))
            spread = lambda of: F.pmod(F.xxhash64("doc"), F.col(of)).cast("int")
            rows = (placed.join(whole, "key")
                    .withColumn("part", F.when(F.col("comp") == F.col("top"), spread("low")).otherwise(F.col("low") + spread("high")))
                    .withColumn("other", F.explode(F.sequence(F.when(F.col("comp") == F.col("top"), F.col("low")).otherwise(F.lit(0)),
                                                              F.col("low") + F.col("high") - 1))))
        else:
            rows = (placed.join(whole.select("key", "all"), "key")
                    .withColumn("part", F.pmod(F.xxhash64("doc"), F.col("all")).cast("int")).withColumn("other", F.col("part")))
        return (rows.join(sizes.select(F.col("doc_id").alias("doc"), "n", "bitmap"), ["doc", "n"])
                .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
                .select("key", "i", "j", "part", "n", "doc", "comp", "bitmap")
                .repartition(n_parts, "key", "i", "j").sortWithinPartitions("key", "i", "j"))

    # Second pass: what shares a list and is not connected yet, first inside blocks, then across them.
    for across in (False, True):
        groups = write_table(met(comp, across).mapInArrow(_candidates(percent), "gid long, side int, doc long, comp long").distinct(), "ngram-groups")
        if not groups.isEmpty():
            held = _set_table(docs, groups.select(F.col("doc").alias("doc_id")).distinct(), k)
            links = (groups.join(held.withColumnRenamed("id", "doc"), "doc").select("gid", "side", "doc", "comp", "shingles")
                     .repartition(n_parts, "gid").sortWithinPartitions("gid").mapInArrow(_joined(percent), "a long, b long"))
            comp = extended(comp, write_table(links, "ngram-links"))
    drop_table(lists)

    o, c = outline.select("doc_id", *whole).alias("o"), classes.join(comp, F.col("rep") == F.col("id"), "left").alias("c")
    joined = o.join(c, F.expr("o.n = c.n AND o.h1 = c.h1 AND o.h2 = c.h2 AND o.doc_id IS NOT NULL"), "left")
    return joined.select("o.doc_id", F.col("o.n").alias("n_shingles"), F.coalesce("c.component", "c.rep", "o.doc_id").alias("component_id"))


def _with_bitmaps(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    a = sizes.toDF("a", "n1", "b1")
    b = sizes.toDF("b", "n2", "b2")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "n1", "n2", "b1", "b2")


def keep_one(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` without the documents of a component but its smallest doc_id (rows without
    doc_id stay; of rows that share a kept doc_id all stay)."""
    kept = join_components(docs, k, percent).filter("component_id = doc_id").select("doc_id").distinct()
    return docs.filter("doc_id IS NULL").unionByName(docs.join(kept, "doc_id", "left_semi"))
