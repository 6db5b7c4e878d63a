"""CSV whose quoted fields hold line breaks, read by many tasks per file (SRC-01, SRC-02).

The built-in reader cannot split such a file: whether a line break ends a record depends on all
quotes before it.  Here lines are read by splits.  The parity of quotes inside a split gives, for
both parities at its begin, which lines begin records; one short row per split carries the parity and the
last record over the splits of a file.  A line that begins a record and has an even number of quotes is a
record; only the other lines are grouped.  Records are parsed by Spark's CSV parser.

Lines cross one exchange, by split; a split has ``spark.sql.files.maxPartitionBytes`` at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.io import read_raw_csv

_PARSE = {"mode": "FAILFAST", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, value, odd, even_n, odd_n): a line, whether its quotes are odd, and how many records have
    begun in its split up to it when the split begins outside (even_n) or inside (odd_n) quotes."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
             .withColumn("odd", (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2))
    inside = Window.partitionBy("file", "block").orderBy("row")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = (F.sum("odd").over(upto) - F.col("odd")) % 2
    return (lines.withColumn("before", before)
            .withColumn("even_n", F.sum(1 - F.col("before")).over(upto)).withColumn("odd_n", F.sum("before").over(upto)))


def _splits(lines: DataFrame) -> DataFrame:
    """(file, block, inside, from_block, from_n): whether the split begins inside quotes (0 or 1), and the
    record that goes on at its begin (a block, and a record's number there).  One row per split."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    per = (lines.groupBy("file", "block").agg(F.sum("odd").alias("quotes"), F.max("even_n").alias("even_n"), F.max("odd_n").alias("odd_n"))
           .withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
           .withColumn("n", F.when(F.col("inside") == 0, F.col("even_n")).otherwise(F.col("odd_n"))))
    last = F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(before)
    return per.withColumn("last", last).select("file", "block", "inside", F.col("last.block").alias("from_block"), F.col("last.n").alias("from_n"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, record): the text of every record, header and blank lines included, with
    the place of its first line (rows ascend inside a block)."""
    lines = _lines(spark, path)
    placed = (lines.alias("l").join(_splits(lines).alias("s"), ["file", "block"])
              .withColumn("n", F.when(F.col("inside") == 0, F.col("even_n")).otherwise(F.col("odd_n")))
              .withColumn("whole", (F.col("before") == F.col("inside")) & (F.col("odd") == 0)))
    whole = placed.where("whole").select("file", "block", "row", F.col("value").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("block", "row", "value")))
    joined = (placed.where("NOT whole")
              .groupBy("file", F.when(F.col("n") > 0, F.col("block")).otherwise(F.col("from_block")).alias("of_block"),
                       F.when(F.col("n") > 0, F.col("n")).otherwise(F.col("from_n")).alias("of_n"))
              .agg(parts.alias("parts"))
              .select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"),
                      F.array_join(F.col("parts.value"), "\n").alias("record")))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_csv_records(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    """Headered CSV with line breaks in quoted fields as all-string columns, as ``read_raw_csv`` with
    ``multi_line`` gives it, whatever the number of splits.

    The header is one line and the same in all files (another one raises); blank lines are skipped, and a record of
    another length raises.  ``with_order`` adds ``_input_order`` (file, block, row).  A file whose last
    quote is never closed ends in one record.
    """
    names = read_raw_csv(spark, path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    found = records(spark, path).where(F.length("record") > 0)
    heads = found.where("block = 0").groupBy("file", "block").agg(F.min("row").alias("row"))
    row = F.from_csv("record", schema.toDDL(), _PARSE)
    parsed = found.withColumn("fields", row).join(heads.withColumn("head", F.lit(True)), ["file", "block", "row"], "left")
    same = F.lit(True)
    for c in names:
        same = same & F.col("fields")[c].eqNullSafe(F.lit(c))
    body = parsed.where(F.when(F.col("head").isNull(), F.lit(True)).when(same, F.lit(False))
                        .otherwise(F.raise_error(F.lit(f"another header below {path}")).cast("boolean")))
    order = [F.struct("file", "block", "row").alias("_input_order")] if with_order else []
    return body.select(*(F.col("fields")[c].alias(c) for c in names), *order)
