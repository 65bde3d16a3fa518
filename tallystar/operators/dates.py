"""Joins of the fact with its date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_PARTS = ("year", "month")


def on_date(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """The fact with ``columns`` of its date (one row a day: bounded, broadcast).

    A fact partitioned by year and month is joined on those too, so a filter
    on the date dimension prunes its partitions while the query runs.
    """
    parts = [c for c in FACT_PARTS if c in fact.columns]
    wanted = ["date_id", *parts, *(c for c in columns if c not in (*parts, "date_id"))]
    return fact.join(F.broadcast(dim_date.select(*wanted)), ["date_id", *parts])
