"""The partitioned and bucketed fact, and the order roll-up."""

import re

import pytest
from pyspark.sql import functions as F

from tallystar.operators import basket, rollup, sales, series
from tallystar.plans import warehouse_job
from tallystar.sources import tables
from tallystar.sources.testdata import star_from_dir


@pytest.fixture(scope="module")
def loaded(spark, sf_dir, tmp_path_factory):
    """The test star as catalog tables, the fact by year and month in buckets."""
    db = "layout_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path_factory.mktemp('layout')}'")
    star = star_from_dir(spark, sf_dir)
    tables.write_table(tables.with_date_parts(star.fact), f"{db}.fact_sales", "overwrite", ["year", "month"], (4, "order_id"))
    tables.write_table(star.dim_date, f"{db}.dim_date", "overwrite")
    yield db, spark.table(f"{db}.fact_sales"), spark.table(f"{db}.dim_date"), star
    spark.sql(f"DROP DATABASE {db} CASCADE")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_the_same(spark, loaded):
    _, fact, _, star = loaded
    assert sorted(map(tuple, fact.select(star.fact.columns).collect())) == sorted(map(tuple, star.fact.collect()))
    assert {c.name for c in spark.catalog.listColumns("layout_db.fact_sales") if c.isPartition} == {"year", "month"}
    assert [c.name for c in spark.catalog.listColumns("layout_db.fact_sales") if c.isBucket] == ["order_id"]


def test_a_filtered_date_dimension_prunes_partitions(spark, loaded):
    _, fact, dim_date, star = loaded
    one_year = dim_date.where("quarter = 2 and year in (1994, 1996)")
    out = series.monthly_series(fact, one_year)
    assert "dynamicpruning" in plan_of(out)
    want = series.monthly_series(star.fact, star.dim_date.where("quarter = 2 and year in (1994, 1996)"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    scan = [line for line in plan_of(out).splitlines() if "FileScan" in line and "total_price" in line]
    assert scan and all(re.search(r"PartitionFilters: \[[^]]*dynamicpruning", line) for line in scan)


def test_work_per_order_needs_no_exchange(spark, loaded):
    db, fact, _, star = loaded
    per_order = fact.groupBy("order_id").agg(F.sum("quantity"), F.count_distinct("product_id"))
    assert "Exchange" not in plan_of(per_order)
    plan = plan_of(rollup.order_rollup(fact))
    assert "Exchange" not in plan
    total = plan_of(basket.total_baskets(fact.select("order_id")))
    assert not re.search(r"Exchange hashpartitioning\(order_id", total)
    rows = fact.select("order_id", "product_id").distinct()
    assert not re.search(r"Exchange hashpartitioning", plan_of(rows))
    assert basket.total_baskets(rows).first()[0] == star.fact.select("order_id").distinct().count()


def test_sink_rejects_other_modes_and_layouts(spark, loaded):
    db, fact, dim_date, _ = loaded
    with pytest.raises(ValueError, match="append or overwrite"):
        tables.write_table(dim_date, f"{db}.dim_date", "errorifexists")
    with pytest.raises(ValueError, match="partitioned by"):
        tables.write_table(fact, f"{db}.fact_sales", "append", ["year"])
    tables.write_table(dim_date.limit(0), f"{db}.dim_date", "append", [])


def test_names_and_queries_are_told_apart(spark, loaded):
    db = loaded[0]
    assert tables.table(spark, f" {db}.dim_date ").count() == tables.table(spark, f"`{db}`.`dim_date`").count() > 0
    assert tables.table(spark, f"select\t1\nas\tone").first()[0] == 1
    assert tables.table(spark, f"select 1 as one from {db}.dim_date limit 3").count() == 3


def test_reports_from_one_rollup_equal_the_fact(spark, sf_dir, monkeypatch):
    star = star_from_dir(spark, sf_dir)
    scans = []
    real = rollup.cut_lineage
    monkeypatch.setattr(rollup, "cut_lineage", lambda df: scans.append(plan_of(df)) or real(df))
    found = rollup.reports(star.fact, star.dim_date, star.dim_time)
    assert len(scans) == 1 and scans[0].count("lineitem.parquet") == 1
    own = {"weekday_line_counts": sales.weekday_line_counts(star.fact, star.dim_date),
           "sales_by_hour": sales.sales_by_hour(star.fact, star.dim_time),
           "sales_by_meal_period": sales.sales_by_meal_period(star.fact, star.dim_time),
           "sales_by_weekday": sales.sales_by_weekday(star.fact, star.dim_date),
           "sales_by_month": sales.sales_by_month(star.fact, star.dim_date),
           "sales_heatmap": sales.sales_heatmap(star.fact, star.dim_date, star.dim_time),
           "daily_series": series.daily_series(star.fact, star.dim_date),
           "weekly_series": series.weekly_series(star.fact, star.dim_date),
           "monthly_series": series.monthly_series(star.fact, star.dim_date),
           "hourly_series": series.hourly_series(star.fact, star.dim_time),
           "daily_by_period": series.daily_by_period(star.fact, star.dim_time),
           "daily_by_weekday": series.daily_by_weekday(star.fact, star.dim_date)}
    assert set(own) == set(found)
    for name, df in own.items():
        assert "lineitem.parquet" not in plan_of(found[name])
        assert found[name].columns == df.columns
        assert sorted(map(str, found[name].collect())) == sorted(map(str, df.collect())), name


def test_sketches_merge_within_their_bound(spark):
    rows = spark.range(60000).selectExpr("id % 20000 as order_id", "date_add(date'2020-01-01', cast(id % 20000 % 9 as int)) as date_id",
                                         "cast(id % 20000 % 4 as int) as time_id")
    hours = spark.createDataFrame([(t, t // 2) for t in range(4)], "time_id int, hour int")
    cells = rollup.order_sketches(rows, hours)
    got = {r.hour: r.about_orders for r in rollup.approximate_orders(cells, "hour").collect()}
    assert set(got) == {0, 1} and all(abs(n - 10000) < 500 for n in got.values())
    assert abs(rollup.approximate_orders(cells).first().about_orders - 20000) < 1000


def test_a_copy_of_changed_files_is_not_used(spark, sf_dir, tmp_path):
    for name in ("lineitem", "orders", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(50).write.parquet(f"{tmp_path}/{name}.parquet")
    warehouse_job.build(spark, str(tmp_path))
    assert warehouse_job.lookup(spark, str(tmp_path)) is not None
    spark.read.parquet(f"{sf_dir}/orders.parquet").limit(60).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert warehouse_job.lookup(spark, str(tmp_path)) is None
    warehouse_job.forget(spark, str(tmp_path))
