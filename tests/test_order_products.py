from pyspark.sql import functions as F

from tallystar.operators import basket, composition


def facts(spark):
    return spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, "a"), (3, None), (None, "a"), (None, "a")],
                                 "order_id long, product_id string")


def test_sizes_and_items_keep_nulls_and_repeats(spark):
    assert {(r.order_id, r.total_items) for r in composition.order_sizes(facts(spark)).collect()} == {
        (1, 2), (2, 1), (3, 0), (None, 1)}
    prod = spark.createDataFrame([("a", "The a", "c"), ("b", "The b", "c")], "product_id string, name string, category string")
    items = basket.order_items(facts(spark), prod)
    assert sorted((r.order_id or 0, r.product_id) for r in items.collect()) == [(0, "a"), (1, "a"), (1, "b"), (2, "a")]


def test_partitions_grow_with_the_lines_and_no_scan_task_holds_its_split(spark, monkeypatch):
    monkeypatch.setattr(composition, "LINES", 100)
    fact = spark.range(2000).select((F.col("id") % 500).alias("order_id"), (F.col("id") % 7).cast("string").alias("product_id"))
    rows = composition.order_products(fact)
    assert rows.rdd.getNumPartitions() >= 20
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    below = plan[plan.rindex("Exchange"):] if "Exchange" in plan else ""
    assert "Exchange" in plan and "Aggregate" not in below
