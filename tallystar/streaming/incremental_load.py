"""Restartable append of newly landed order-line files into the fact table.

The reference appends each load to its warehouse tables. As a stream that is
a file source over the landing folder plus ``foreachBatch``: every
micro-batch of new order lines is joined to the order headers and the price
list (``operators.warehouse.build_fact``) and written to its own
``batch_id=<n>`` folder under the fact path with overwrite, so a batch that
is replayed after a failure replaces its own output instead of appending a
duplicate. The checkpoint (offsets and commits) lives in the shared folder
the caller names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystar.operators.warehouse import build_fact
from tallystar.sources.csv import LINE_SCHEMA


def start_fact_append(spark: SparkSession, landing_dir: str, fact_path: str, checkpoint: str,
                      orders: Callable[[], DataFrame], dim_sku: Callable[[], DataFrame],
                      available_now: bool = True, max_files_per_trigger: int | None = None
                      ) -> StreamingQuery:
    """Start the stream. ``orders`` and ``dim_sku`` are loaders called once per
    micro-batch, so headers and prices landed since the last batch are seen."""
    reader = spark.readStream.schema(LINE_SCHEMA).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.csv(landing_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fact = build_fact(batch, orders(), dim_sku())
        (fact.withColumn("loaded_batch", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{fact_path.rstrip('/')}/batch_id={batch_id}"))

    writer = (lines.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
