"""Session helpers.

All timestamps are handled as UTC wall-clock values (``timestamp_ntz``); parsing
zoned text goes through the session time zone, which is pinned to UTC here.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Session-level SQL settings every job in this package relies on.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so spark-submit decides.  The UI stays off.
    """
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) when the
    cluster names one.  Only a ``local`` master without either gets a scratch
    folder of its own; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{id(spark)}"


def run_concurrently(thunks: Sequence[Callable[[], object]], max_jobs: int = 8) -> list:
    """Run independent Spark actions (e.g. the writes of one layer) as concurrent
    jobs of the same session and return their results in order.

    Jobs submitted from several driver threads share the executors, so a job
    that cannot use every core (a scan of few large files) leaves room for
    the others.  Only independent work belongs in one call.
    """
    if len(thunks) <= 1:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=min(max_jobs, len(thunks))) as pool:
        return list(pool.map(lambda t: t(), thunks))
