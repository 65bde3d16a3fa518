"""Large tables are dealt by rows: no sort of a task grows with them."""

import pytest
from pyspark.sql import functions as F

from tallystar import session
from tallystar.operators import basket
from tallystar.sources import testdata


@pytest.fixture
def small_tasks(monkeypatch):
    for module in (session, testdata):
        monkeypatch.setattr(module, "ROWS_PER_TASK", 100)


def tables(spark):
    lines = spark.createDataFrame(
        [(i % 700 if i % 50 else None, i % 310 if i % 41 else None, i % 7, float(i % 9)) for i in range(2000)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")
    orders = spark.createDataFrame([(i, f"2020-01-{i % 28 + 1:02d}") for i in [*range(650), 3, 3]], "o_orderkey long, o_orderdate string")
    part = spark.createDataFrame([(i, f"Brand#{i % 25 + 10}", i % 50, 1.0 + i % 25) for i in range(300)],
                                 "p_partkey long, p_brand string, p_size int, p_retailprice double")
    return lines, orders, part


def test_fact_is_the_same_and_its_joins_are_dealt_by_lines(spark, small_tasks, monkeypatch):
    fact = testdata.star_from_tables(*tables(spark)).fact
    assert fact.rdd.getNumPartitions() == 20
    dealt = fact.collect()
    monkeypatch.setattr(session, "ROWS_PER_TASK", 1_000_000)
    plain = testdata.star_from_tables(*tables(spark)).fact
    assert plain.rdd.getNumPartitions() < 20
    assert sorted(map(str, dealt)) == sorted(map(str, plain.collect()))


def test_pairs_are_the_same_and_orders_are_dealt_by_rows(spark, small_tasks, monkeypatch):
    star = testdata.star_from_tables(*tables(spark))
    items = basket.order_items(star.fact, star.dim_product)
    seen = []
    real = basket.pair_counts
    monkeypatch.setattr(basket, "pair_counts", lambda rows, *a: (seen.append(a[2]), real(rows, *a))[1])
    dealt = basket.pair_support(items, star.dim_product).collect(), basket.pair_lift(items, star.dim_product, 2).collect()
    assert min(seen) >= 10
    monkeypatch.setattr(session, "ROWS_PER_TASK", 1_000_000)
    plain = basket.pair_support(items, star.dim_product).collect(), basket.pair_lift(items, star.dim_product, 2).collect()
    assert seen[2:] == [None, None] and dealt[0]
    assert sorted(dealt[0]) == sorted(plain[0]) and sorted(dealt[1]) == sorted(plain[1])


def test_small_tables_are_left_to_the_session(spark):
    assert session.deal_count(spark.range(1000)) is None
    assert session.dealt(spark.range(10), None, "id").where(F.col("id") > 8).count() == 1
