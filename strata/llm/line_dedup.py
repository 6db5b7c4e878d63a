"""Line dedup with DataFrame functions only.

Lines are hashed once, range-partitioned by (hash, document) and sorted by document and
position inside each range; one streaming pass marks the first line of every
(hash, document).  Per hash and range that leaves a document count and the largest document, and
few rows join the ranges of a hash that spans several; lines are answered inside their range, so
that a hot line stays spread.  The decision comes back as one compressed bitmap per document
(64 lines a word, only words with a dropped line), never as text.

Defined cases: a null text is one empty line; rows without doc_id keep all their lines
and do not count as holders; rows that share a doc_id are one document for the count,
and each keeps its own text; an empty table gives empty results; extra columns pass
through ``apply_bitmaps`` untouched, whatever their names: where the input has a column
``n_lines`` or ``n_dropped``, the added one takes underscores in front until its name is free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ._common import drop_table, write_table

_SPACES = " \t\n\x0b\f\r"
_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACES)), _UPPER, _LOW)


def _text_id(text: Column) -> Column:
    """Tells rows apart that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_id, n_dropped, words) for each document that loses lines; ``words`` is
    an array of (index, bits), bit p % 64 of word p / 64 set when line p goes.

    A line goes when its key (white space stripped, A-Z lowered) has ``min_chars`` code
    points, is found in ``min_docs`` documents, and a larger doc_id holds it as well.
    """
    keyed = (docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
             .select("doc_id", _text_id(F.col("text")).alias("text_id"),
                     F.posexplode(F.transform(_lines(F.col("text")), _key)).alias("pos", "line"))
             .filter(F.length("line") >= min_chars)
             .select("doc_id", "text_id", "pos", F.xxhash64("line").alias("h1"),
                     F.xxhash64(F.lit("line"), "line").alias("h2")))
    # Written first: the bounds of the ranges are sampled from hashes, not by cutting the texts again.
    keyed = write_table(keyed, "line-hashes")
    # Equal (hash, document) rows share a range, a hot hash spans many ranges; the window reads them as sorted.
    first = F.row_number().over(Window.partitionBy("h1", "h2", "doc_id").orderBy("pos", "text_id")) == 1
    ranged = write_table(keyed.repartitionByRange("h1", "h2", "doc_id")
                         .sortWithinPartitions("h1", "h2", "doc_id", "pos", "text_id").withColumn("first", first)
                         .withColumn("range", F.spark_partition_id()), "line-ranges")
    drop_table(keyed)
    parts = write_table(ranged.filter("first").groupBy("h1", "h2", "range").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")), "line-holders")
    holders = parts.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("last").alias("last")).filter(F.col("n") >= min_docs).drop("n")
    answers = parts.select("h1", "h2", "range").join(holders, ["h1", "h2"])
    gone = ranged.join(answers, ["h1", "h2", "range"]).filter("doc_id < last")
    word = F.floor(F.col("pos") / 64).cast("int")
    return (gone.groupBy("doc_id", "text_id", word.alias("index"))
            .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
            .groupBy("doc_id", "text_id")
            .agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
                 F.sort_array(F.collect_list(F.struct("index", "bits"))).alias("words")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as text (a null text stays null when nothing goes),
    plus ``n_lines`` and ``n_dropped``."""
    taken = set(docs.columns)
    free = lambda c: c if c not in taken else free("_" + c)
    tid, count, dropped, words, doc, mark = (free(c) for c in ("text_id", "n_lines", "n_dropped", "words", "mark_doc", "mark_text"))
    marks = bitmaps.select(F.col("doc_id").alias(doc), F.col("text_id").alias(mark), F.col("n_dropped").alias(dropped), F.col("words").alias(words))
    out = docs.withColumn(tid, _text_id(F.col("text")))
    out = out.join(marks, (F.col("doc_id") == F.col(doc)) & (F.col(tid) == F.col(mark)), "left")
    gone = F.flatten(F.transform(words, lambda w: F.filter(
        F.sequence(w["index"] * 64, w["index"] * 64 + 63),
        lambda p: F.expr("1").cast("long").eqNullSafe(_bit(w["bits"], p)))))
    # a lambda variable holds the lines, so that they are split once and not for every kept line
    kept = F.get(F.transform(F.array(_lines(F.col("text"))), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda p: F.get(lines, p)), "\n")), 0)
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    new = {"text": F.when(F.col(words).isNull(), F.col("text")).otherwise(kept)}
    return out.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns),
                      (F.coalesce(breaks, F.lit(0)) + 1).cast("long").alias(count),
                      F.coalesce(F.col(dropped), F.lit(0)).cast("long").alias(dropped))


def _bit(bits: Column, p: Column) -> Column:
    return F.call_function("getbit", bits, (p % 64).cast("int")).cast("long")


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
