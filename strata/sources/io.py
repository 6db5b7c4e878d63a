"""CSV / Parquet / table sources and sinks (SRC-01..12).

Paths are Hadoop FS URIs (local, HDFS, object stores alike).  Scratch output
goes under the shared checkpoint folder of the session (``strata.session``),
never a machine-local temp folder.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNNAMED = re.compile(r"^Unnamed", re.IGNORECASE)


# SRC-01
def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                 with_order: bool = False, multi_line: bool = False) -> DataFrame:
    """Headered CSV as all-string columns.  Fails if the path does not exist.

    Quotes inside a quoted field are doubled, a backslash is a plain character, and an
    empty field is NULL, quoted or not.  The
    header decides the names (every file's header is checked against the first); ``columns``
    selects from them by name and fails for a missing one.  ``multi_line`` reads line
    breaks inside quoted fields; such a file cannot be split, so one task reads each
    file (``csv_records.read_csv_records`` reads it by splits).  ``with_order`` adds ``_input_order`` — a struct of (file, block start, row id)
    that restores line order for keep-first rules.
    """
    df = (spark.read.option("header", True).option("mode", "FAILFAST").option("inferSchema", False)
          .option("escape", '"').option("enforceSchema", False).option("multiLine", multi_line)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    if columns:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"columns not in the header of {path}: {', '.join(missing)}")
    if with_order:
        df = df.withColumn("_input_order", F.struct(
            F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row")))
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns], *(["_input_order"] if with_order else []))
    return df


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite", multi_line: bool = False) -> str:
    """Headered CSV keeping blanks as they are (NULL → empty field, '' → quoted), quotes doubled.

    A value with a line break fails the write unless ``multi_line``: only a reader with
    ``multi_line`` reads it back.
    """
    if not multi_line:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: F.when(F.col(f"`{c}`").rlike(r"[\r\n]"), F.raise_error(F.lit(
            f"line break in column {c}: write and read this CSV with multi_line"))).otherwise(F.col(f"`{c}`"))
            for c in text}) if text else df
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


# SRC-03
def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop left-over index columns whose name starts with ``Unnamed`` (any case)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not UNNAMED.match(c)])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_csv(spark: SparkSession, src: str) -> list[str]:
    """Sorted ``*.csv`` entries (files or Spark output folders) of a directory — metadata only."""
    fs, p = _fs(spark, src)
    if not fs.exists(p):
        raise FileNotFoundError(src)
    names = [s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().lower().endswith(".csv")]
    return sorted(names)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


# SRC-04
def csv_to_parquet(spark: SparkSession, src: str, dst: str, line_breaks: bool = False) -> str:
    """``line_breaks``: quoted fields hold line breaks (read by splits, see ``csv_records``)."""
    from strata.sources.csv_records import read_csv_records
    read = read_csv_records if line_breaks else read_raw_csv
    drop_unnamed(read(spark, src)).write.mode("overwrite").parquet(dst)
    return dst


# SRC-02 / SRC-05
def ingest_dir(spark: SparkSession, src: str, dst: str, line_breaks: bool = False) -> dict[str, str]:
    """Every ``*.csv`` of ``src`` (sorted) → ``<dst>/raw_<stem>.parquet``; error when none."""
    files = list_csv(spark, src)
    if not files:
        raise ValueError(f"No CSV files found in {src}")
    out = {}
    for f in files:
        stem = re.sub(r"\.csv$", "", f.rstrip("/").rsplit("/", 1)[-1], flags=re.IGNORECASE)
        out[stem] = csv_to_parquet(spark, f, f"{dst.rstrip('/')}/raw_{stem}.parquet", line_breaks)
    return out


# SRC-06 / SRC-07
def load_table(spark: SparkSession, uri: str, name: str, location: str | None = None,
               mode: str = "overwrite", count: bool = True) -> int | None:
    """Load landed Parquet into table ``name`` (replace or append) and return its row
    count (None without ``count``).

    With ``location`` the table is a Parquet folder exposed as a view; without
    it a catalog table (``saveAsTable``).
    """
    df = spark.read.parquet(uri)
    if location:
        df.write.mode(mode).parquet(location)
        spark.read.parquet(location).createOrReplaceTempView(name)
    else:
        df.write.mode(mode).saveAsTable(name)
    return spark.table(name).count() if count else None


def register(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Name the Parquet folder ``path`` as external table ``database.name``; an older table of
    that name is replaced in the catalog, and its files stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    spark.catalog.createTable(f"`{database}`.`{name}`", path=path, source="parquet")
    if any("=" in p.getPath().getName() for p in _fs(spark, path)[0].listStatus(_fs(spark, path)[1])):
        spark.catalog.recoverPartitions(f"`{database}`.`{name}`")


# SRC-09
def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Headered CSV; timestamps written as UTC with an explicit ``+00:00`` offset."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
        cols.append(c.alias(f.name))
    return write_raw_csv(df.select(*cols), path, mode)


# SRC-10
def write_table(df: DataFrame, path: str, partition_by_day: str | None = None, mode: str = "overwrite",
                day_col: str | None = None, observe: tuple[Observation, Sequence[Column]] | None = None) -> str:
    """Full-refresh Parquet table; optionally partitioned by the day of a timestamp column.

    The day column (``<ts>_date`` unless named) is added so readers can prune
    directories with a date predicate.  ``observe`` takes aggregates (counts, hashes) from the rows as they are written, in the
    tasks of the write itself.
    """
    w = df
    parts = []
    if partition_by_day:
        day = day_col or f"{partition_by_day}_date"
        if day not in df.columns:
            w = df.withColumn(day, F.to_date(F.col(partition_by_day)))
        parts = [day]
        # cluster rows by day before writing (few files per folder); the
        # rebalance hint lets AQE split a hot day over several tasks
        w = w.hint("rebalance", day)
    if observe:
        w = w.observe(observe[0], *observe[1])
    writer = w.write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    return path


def read_partitioned(spark: SparkSession, path: str, ts_col: str | None = None, start=None, end=None,
                     day_col: str | None = None) -> DataFrame:
    """Read a day-partitioned table; a time range adds both the timestamp and the
    date predicate so the scan prunes folders *and* pushes the row filter."""
    df = spark.read.parquet(path)
    if ts_col and (start is not None or end is not None):
        day = day_col or f"{ts_col}_date"
        if start is not None:
            df = df.where((F.col(day) >= F.to_date(F.lit(start))) & (F.col(ts_col) >= F.lit(start).cast("timestamp_ntz")))
        if end is not None:
            df = df.where((F.col(day) <= F.to_date(F.lit(end))) & (F.col(ts_col) < F.lit(end).cast("timestamp_ntz")))
    return df


# SRC-11
def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# lineage cut: a written table in the shared checkpoint folder
def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the session's shared checkpoint folder
    and return the scan of it.  Consumers that read a table many times (the
    check report, the next layer) then scan columnar files with pushdown instead
    of recomputing the lineage; a lost executor recomputes nothing upstream."""
    import uuid

    from strata.session import scratch_path

    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
