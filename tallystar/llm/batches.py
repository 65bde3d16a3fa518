"""Size of the batches that Python tasks get, and the memory they leave."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of this session end at BATCH_BYTES (Spark's default: 10,000
    rows or 64 MB), so a task's memory does not grow with the length of texts;
    a single longer row is a batch of its own. Results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def release() -> None:
    """Give freed memory back to the machine: Python workers are kept for later
    stages, and what they hold while idle counts against those."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass                                    # no glibc: nothing to trim


def tidy(task):
    """An iterator function for mapInPandas or mapInArrow that releases its
    memory when it ends."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release()
    return run
