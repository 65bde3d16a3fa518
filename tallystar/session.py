"""Spark session helpers.

Library code never creates a session on its own; callers pass one in. These
helpers exist for tests, the bench and command-line jobs, and for reading the
shared checkpoint folder from whatever session the cluster hands us.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session we build ourselves gets. On a cluster these come from
# the job submission; locally they keep plans close to what a cluster would run.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


ROWS_PER_TASK = 1_000_000    # rows in one partition of a large shuffle


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tallystar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TALLYSTAR_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster configured.

    The setting is always read from the session. Only a single-machine
    session (tests, the bench) that has none gets a scratch folder of its
    own; a cluster session without one is an error, because executors could
    not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", sc.master or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tallystar-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


# Scratch tables of this process that were not dropped yet, oldest first.
SCRATCH: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in the shared checkpoint folder, removed when the
    application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    SCRATCH.append(path)
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def drop_scratch_since(spark: SparkSession, mark: int) -> None:
    """Remove the scratch tables written from number ``mark`` of SCRATCH on,
    all but the last: a step whose result is that last table needs no other."""
    for path in SCRATCH[mark:-1]:
        drop_scratch(spark, path)
    del SCRATCH[mark:-1]


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def deal_count(rows) -> int | None:
    """Partitions of about ROWS_PER_TASK rows for a shuffle of ``rows``, or None
    where the session's own dealing has no more: one partition for each core,
    to which AQE joins the shuffled ones. AQE goes by compressed bytes, so the
    rows of a task (and what sorting them takes) would grow with the table."""
    spark = rows.sparkSession
    own = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = -(-rows.count() // ROWS_PER_TASK)
    return n if n > own else None


def dealt(rows, n: int | None, *keys: str):
    """``rows`` in ``n`` partitions by ``keys`` (see ``deal_count``)."""
    return rows if n is None else rows.repartition(n, *keys)


def few_files(df, rows: int = 0, per_task: int = ROWS_PER_TASK):
    """``df`` in no more tasks than its ``rows`` need (``per_task`` each), but a
    few for each core: every file that a task writes makes the local file system
    start a process beside the executor."""
    return df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task)))


def cut_lineage(df):
    """Materialise an intermediate as a parquet table in the shared
    checkpoint folder and continue from it.

    Used where one intermediate feeds several branches of a plan: the
    upstream (a scan and aggregate of the fact, a chain of windows) then runs
    exactly once, and a lost executor re-reads the files instead of
    recomputing the lineage. One write job (an RDD ``checkpoint()`` of an
    uncached frame would compute it twice); ``localCheckpoint`` is never used.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
