"""Incremental fact append: new files only, replay-safe batches."""

import decimal

from tallystar.operators import warehouse
from tallystar.sources import csv
from tallystar.streaming.incremental_load import start_fact_append


def test_append_only_new_files(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    (tmp_path / "orders.csv").write_text("order_id,date,time\n1,2015-01-01,12:00:00\n2,2015-01-02,18:30:00\n")
    (tmp_path / "pizzas.csv").write_text("pizza_id,pizza_type_id,size,price\na_m,a,M,10.00\nb_l,b,L,12.50\n")
    (land / "d1.csv").write_text("order_details_id,order_id,pizza_id,quantity\n1,1,a_m,2\n2,1,b_l,1\n")

    def orders():
        return csv.read_orders(spark, str(tmp_path / "orders.csv"))

    def sku():
        return warehouse.build_dim_sku(csv.read_skus(spark, str(tmp_path / "pizzas.csv")))

    fact_path, ckpt = str(tmp_path / "fact"), str(tmp_path / "ckpt")
    start_fact_append(spark, str(land), fact_path, ckpt, orders, sku).awaitTermination()
    assert spark.read.parquet(fact_path).count() == 2

    (land / "d2.csv").write_text("order_details_id,order_id,pizza_id,quantity\n3,2,a_m,1\n")
    start_fact_append(spark, str(land), fact_path, ckpt, orders, sku).awaitTermination()
    fact = spark.read.parquet(fact_path)
    assert fact.count() == 3
    assert fact.filter("line_id = 1").first().total_price == decimal.Decimal("20.00")
