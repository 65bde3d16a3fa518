"""Small literal tables and generated calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of literal rows (holidays, expected counts, label tables)."""
    return spark.createDataFrame(list(rows), schema)


def calendar(bounds: DataFrame, start: str | Column = "min_date", end: str | Column = "max_date",
             name: str = "date_id") -> DataFrame:
    """Every day between ``start`` and ``end`` of each row of ``bounds``.

    ``bounds`` is normally a one-row aggregate (min/max of a series), or one
    row per series; the days are generated on the executors with
    ``explode(sequence(...))``, never on the driver.
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    keep = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(*keep, F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias(name))


def calendar_of(df: DataFrame, date_col: str = "date_id", keys: Sequence[str] = ()) -> DataFrame:
    """Calendar spanning the min and max of ``date_col`` (per ``keys`` group)."""
    agg = [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    bounds = df.groupBy(*keys).agg(*agg) if keys else df.agg(*agg)
    return calendar(bounds, name=date_col)
