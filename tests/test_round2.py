"""Orphan lines stay in the fact; wide counts, times and NULL keys."""

import datetime

from pyspark.sql import functions as F

from tallystar.functions.scalar import share_pct
from tallystar.operators import audit
from tallystar.operators.cooccur import pair_counts
from tallystar.sources.csv import seconds_of_day
from tallystar.sources.testdata import star_from_tables


def test_orphan_lines_stay(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    orders = spark.createDataFrame([(1, datetime.date(1995, 1, 2)), (9, datetime.date(1995, 1, 3))],
                                   "o_orderkey long, o_orderdate date")
    known = part.first()["p_partkey"]
    lines = spark.createDataFrame([(1, known, 1, 2.0), (2, known, 1, 1.0), (1, -5, 2, 1.0)],
                                  "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")
    s = star_from_tables(lines, orders, part)
    assert s.fact.count() == 3
    assert s.dim_time.count() == 2          # the order without lines has a time too
    found = {r.check_name: r.orphaned_rows for r in audit.audit_orphans(
        s.fact, [("sku", s.dim_sku, "sku_id"), ("date", s.dim_date, "date_id"), ("time", s.dim_time, "time_id")]).collect()}
    assert found == {"sku": 1, "date": 1, "time": 1}


def test_wide_share(spark):
    df = spark.sql("select 150000000000000000L as a, 300000000000000000L as b")
    assert df.select(share_pct("a", "b")).first()[0] == 50.0


def test_times(spark):
    df = spark.createDataFrame([("11:38:36",), ("12:30",), ("junk",), ("25:99:99",), (None,)], "t string")
    assert [r[0] for r in df.select(seconds_of_day(F.col("t"))).collect()] == [41916, 45000, None, None, None]


def test_duplicates_count_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (1, 1)], "a int, b int")
    assert audit.duplicate_keys(df, ["a", "b"]).first()["duplicates"] == 0


def test_null_groups_hold_no_pairs(spark):
    rows = spark.createDataFrame([(None, i) for i in range(9)] + [(1, i) for i in range(9)], "g int, item long")
    out = pair_counts(rows, ["g"], "item").collect()
    assert len(out) == 36 and all(r.n == 1 for r in out)
