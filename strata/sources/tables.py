"""Reading the driver's parquet tables and named sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Scans of the read-only driver tables, per session: a DataFrame is only a plan,
# so reusing it saves the file listing and footer read of each new reader.
_SCANS: dict[tuple[int, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` — the scan prunes columns and pushes filters."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _SCANS[key] = spark.read.parquet(path)
    return df


# SRC-08: named sources with a physical alias (``players`` → ``players_1000``).
def source(spark: SparkSession, registry: dict[str, str], name: str, fmt: str = "parquet") -> DataFrame:
    """Resolve a logical source name through ``registry`` (name → path or table)."""
    target = registry[name]
    if "/" in target or ":" in target:
        return spark.read.format(fmt).load(target)
    return spark.table(target)
