"""Mixing sources to target weights with DataFrame functions only.

Each source's words are packed, in a pseudorandom document order, into blocks of
``block`` words.  The slots that the targets give the sources lie on one line, which a
pseudorandom permutation deals over the output shards of ``shard`` slots: the source counts of
a shard are a multinomial draw given the totals (so the totals meet the targets, which free
draws would miss).  Slot i of a source reads block perm(i mod n_blocks) of pass i / n_blocks;
every source and pass has a permutation of its own, and blocks meet their documents by index.
Permutations are swap-or-not shuffles: bijections on any number of indices, computed from the index alone.

Targets stop at ``cap`` times a source's size, so no block is read more than ``ceil(cap)``
times.  All draws are hashes of indices: reruns agree, whatever the partitioning.

Defined cases: a null text has no words; a null source is a source of its own, last in
order; rows that share a doc_id are separate documents, equal ones too: copies of a row are
numbered, each reads its own blocks; sources without words get target 0; an empty table gives
no rows; other columns pass through, whatever their names.  One row per source passes one task
(running sums over sources).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ._common import WHITESPACE, shuffle_partitions, write_table

WORD = rf"[^{WHITESPACE}]+"
#: Documents in one bucket of the running sums.
BUCKET = 2048
#: Slots, or copies of a row, that are made from one row.
CHUNK = 1 << 12
#: Rounds of a permutation.
ROUNDS = 24


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words; what exceeds ``cap`` times a source's size is shared again by
    weight among the others.  In order of size / weight the sources at their cap are a
    prefix, so one running sum gives the water level in closed form.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    all_ = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(all_) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_ = F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    s = (sizes.withColumn("w", w).withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
         .withColumn("rank", F.row_number().over(by_ratio)).withColumn("level", left / open_))
    fits = F.when(F.col("level") <= F.col("limit") / F.col("w"), F.col("rank"))
    level = F.min_by("level", fits).over(all_)
    return s.select("source", "source_size", "w", F.least("limit", F.coalesce(level * F.col("w"), F.col("limit"))).alias("target"))


def _sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_id, copies) of the distinct documents."""
    rows = docs.select("doc_id", "source", _size(F.col("text")).alias("size"), F.xxhash64("text").alias("text_id"))
    return write_table(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "mix-sizes")


def _dealt(df: DataFrame, count: str, name: str) -> DataFrame:
    """Each row of ``df`` ``count`` times, numbered by ``name``, dealt over tasks in chunks."""
    return (df.withColumn(name, F.explode(F.expr(f"sequence(0L, ({count} - 1) div {CHUNK})"))).repartition(shuffle_partitions(df.sparkSession))
            .withColumn(name, F.explode(F.expr(f"sequence({name} * {CHUNK}, least({name} * {CHUNK} + {CHUNK}, {count}) - 1)"))).drop(count))


def _copied(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as often as ``copies`` says, numbered by ``copy``; only rows of many copies are dealt."""
    few = df.filter(F.col("copies") <= CHUNK).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return few.drop("copies").unionByName(_dealt(df.filter(F.col("copies") > CHUNK), "copies", "copy"))


def _packed(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in the word stream of their source, and the sizes by source.

    Running sums go over (source, bucket) groups of bounded size, then over buckets.
    """
    buckets = max(1, (base.agg(F.sum("copies")).first()[0] or 0) // BUCKET)
    base = (_copied(base).withColumn("at", F.xxhash64("doc_id", "text_id", "copy"))
            .withColumn("bucket", F.pmod(F.col("at"), F.lit(buckets))))
    sums = base.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    starts = sums.withColumn("base", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).drop("n")
    inside = Window.partitionBy("source", "bucket").orderBy("at", "doc_id", "text_id", "copy").rowsBetween(Window.unboundedPreceding, 0)
    placed = (base.withColumn("run", F.sum("size").over(inside) - F.col("size")).alias("d")
              .join(starts.alias("s"), F.expr("d.source <=> s.source AND d.bucket = s.bucket"))
              .select("d.doc_id", "d.text_id", "d.copy", "d.source", "d.size", (F.col("run") + F.col("base")).alias("start")))
    return placed, sums.groupBy("source").agg(F.sum("n").alias("source_size"))


def permuted(index: Column, n: Column, key: Column) -> Column:
    """A pseudorandom bijection of 0 .. n - 1, chosen by ``key`` (a long): in each round an index and its
    mirror image change places or not, by a hash of the larger of the two."""

    def turn(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        return F.when(F.xxhash64(key, r, F.greatest(x, mirror)) >= 0, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, turn)


def block_reads(sources: DataFrame, block: int, shard: int, cap: float, seed: int) -> DataFrame:
    """(source, block, pass, k, i): the block that slot i of each source reads, in shard k.

    ``sources`` has one row per source with source_size and target.
    """
    all_, order = Window.partitionBy(), Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    n_blocks = F.ceil(F.col("source_size") / block).cast("long")
    # the last block is shorter than the others: count slots in mean blocks, so words meet the target
    slots = F.least(F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")), F.floor(F.col("n_blocks") * float(cap))).cast("long")
    s = (sources.filter("source_size > 0").withColumn("n_blocks", n_blocks).withColumn("slots", slots)
         .withColumn("lo", F.sum("slots").over(order) - F.col("slots")).withColumn("line", F.sum("slots").over(all_))
         .select("source", "n_blocks", "lo", "line", "slots"))
    at = permuted(F.col("lo") + F.col("i"), F.col("line"), F.lit(seed).cast("long"))
    turn = F.expr("i div n_blocks")
    index = permuted(F.col("i") % F.col("n_blocks"), F.col("n_blocks"), F.xxhash64(F.lit(seed + 1), "source", turn))
    return _dealt(s.filter("slots > 0"), "slots", "i").select("source", index.alias("block"), turn.cast("int").alias("pass"),
                                            F.floor(at / shard).cast("long").alias("k"), "i")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
        block: int = 64, shard: int = 4096, seed: int = 17) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(segments, sources, sizes).  A segment is a run of words that one slot reads from one
    document: doc_id, text_id, copy, source, pass, shard, slot, block, offset, from_word, n_words
    (a document without words has none).  ``sources`` has source, source_size, w, target;
    ``sizes`` one row per distinct document: doc_id, source, size, text_id, copies."""
    base = _sizes(docs)
    placed, totals = _packed(base)
    sources = write_table(targets(totals, weights, share, cap), "mix-targets")
    reads = block_reads(sources, block, shard, cap, seed)
    pieces = (placed.filter("size > 0")
              .withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
              .withColumn("from_word", F.greatest(F.lit(0).cast("long"), F.col("block") * block - F.col("start")))
              .withColumn("n_words", F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start")) - F.col("from_word"))
              .withColumn("offset", F.col("start") + F.col("from_word") - F.col("block") * block))
    segments = (pieces.alias("p").join(reads.alias("r").hint("merge"), F.expr("p.block = r.block AND p.source <=> r.source"))
                .select("p.doc_id", "p.text_id", "p.copy", "p.source", "r.pass", F.col("r.k").alias("shard"), F.col("r.i").alias("slot"),
                        "p.block", "p.offset", "p.from_word", "p.n_words"))
    return segments, sources, base


_ROW = ("doc_id", "text_id", "source", "copy")


def _same(a: str, b: str, names: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{a}.{c} <=> {b}.{c}" for c in names))


def words_taken(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    segments, sources, sizes = mix(docs, **options)
    taken = segments.groupBy(*_ROW).agg(F.sum("n_words").alias("taken"))
    return (_copied(sizes).alias("d").join(sources.alias("s"), F.expr("d.source <=> s.source"), "left")
            .join(taken.alias("t"), _same("d", "t", _ROW), "left")
            .select("d.doc_id", "d.size", "s.source_size", "s.target", F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken")))


def _numbered(docs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(text_id, copy, row): ``docs`` as structs, copies of a document numbered from 0.

    Copies are numbered inside input partitions, then partitions by their counts, so that no document's
    copies meet in one task; the numbers are written before they are used.
    """
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_id"), F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    many = write_table(sizes.filter("copies > 1 AND size > 0").select("doc_id", "text_id", "source"), "mix-copies")
    if many.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    own = _ROW[:3]
    inside = Window.partitionBy(*own, "part").orderBy(F.xxhash64("row"))
    repeated = write_table(rows.alias("d").join(many.alias("m"), _same("d", "m", own), "left_semi").withColumn("part", F.spark_partition_id())
                           .withColumn("number", F.row_number().over(inside)), "mix-copies")
    counts = repeated.groupBy(*own, "part").agg(F.count("*").alias("c"))
    counts = counts.withColumn("base", F.sum("c").over(Window.partitionBy(*own).orderBy("part")) - F.col("c")).drop("c")
    repeated = (repeated.alias("d").join(counts.alias("m"), _same("d", "m", (*own, "part")))
                .select("d.doc_id", "d.source", "d.text_id", "d.row", (F.col("number") + F.col("base") - 1).alias("copy")))
    once = rows.alias("d").join(many.alias("m"), _same("d", "m", own), "left_anti").withColumn("copy", F.lit(0).cast("long"))
    return once.unionByName(repeated)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix reads them, in its own columns: per document and pass one row whose text
    is what the pass reads of it, whole blocks in text order (white space inside and between kept)."""
    segments, _, sizes = mix(docs, **options)
    runs = segments.groupBy(*_ROW, "pass").agg(F.sort_array(F.collect_list(F.struct("from_word", "n_words"))).alias("runs"))
    words = F.regexp_extract_all("d.row.text", F.lit(rf"[{WHITESPACE}]*[^{WHITESPACE}]+"), F.lit(0))
    # a lambda variable holds the words, so that they are split once and not for every run
    text = F.get(F.transform(F.array(words), lambda w: F.array_join(F.transform("r.runs", lambda r: F.array_join(
        F.slice(w, (r["from_word"] + 1).cast("int"), r["n_words"].cast("int")), "")), "")), 0)
    out = (_numbered(docs, sizes).alias("d").join(runs.alias("r"), _same("d", "r", _ROW))
           .select("d.row", F.btrim(text, F.lit(" \t\n\x0b\f\r")).alias("read")))
    new = {"text": F.col("read")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("read").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
