"""Raw CSV ingest, warehouse build and table sinks."""

import datetime as dt
import decimal
import os


from tallystar.operators import audit, sales, warehouse
from tallystar.sources import csv, tables
from tallystar.sources.literal import calendar_of, literal_rows


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)


def _raw(tmp_path):
    _write(tmp_path / "pizza_types.csv",
           'pizza_type_id,name,category,ingredients\n'
           'bbq,The BBQ Pizza,Chicken,"Chicken, Onions"\n'
           'mex,The Mexicana,Veggie,"Jalapeño, Corn"\n', encoding="latin-1")
    _write(tmp_path / "pizzas.csv",
           "pizza_id,pizza_type_id,size,price\n"
           "bbq_s,bbq,S,12.75\nbbq_m,bbq,M,16.75\nbbq_l,bbq,L,20.75\n"
           "mex_m,mex,M,16.00\nmex_l,mex,L,20.25\nmex_xxl,mex,XXL,35.95\n")
    _write(tmp_path / "orders.csv",
           "order_id,date,time\n1,2015-01-01,11:38:36\n2,2015-01-01,19:02:00\n3,2015-01-02,09:52:11\n")
    _write(tmp_path / "order_details.csv",
           "order_details_id,order_id,pizza_id,quantity\n"
           "1,1,bbq_m,1\n2,1,mex_l,2\n3,2,bbq_m,1\n4,3,bbq_l,1\n5,3,mex_m,3\n")
    return tmp_path


def test_csv_to_star_schema(spark, tmp_path):
    d = _raw(tmp_path)
    prod = warehouse.build_dim_product(csv.read_products(spark, str(d / "pizza_types.csv")))
    sku = warehouse.build_dim_sku(csv.read_skus(spark, str(d / "pizzas.csv")))
    orders = csv.read_orders(spark, str(d / "orders.csv"))
    lines = csv.read_order_lines(spark, str(d / "order_details.csv"))
    assert {r.ingredients for r in prod.collect()} == {"Chicken, Onions", "Jalapeño, Corn"}
    dd = warehouse.build_dim_date(orders).orderBy("date_id").collect()
    assert [(r.date_id, r.day_of_week, r.day_name, r.is_weekend) for r in dd] == \
        [(dt.date(2015, 1, 1), 4, "Thursday", 0), (dt.date(2015, 1, 2), 5, "Friday", 0)]
    tm = {r.time_id: (r.hour, r.minute, r.meal_period) for r in warehouse.build_dim_time(orders).collect()}
    assert tm[11 * 3600 + 38 * 60 + 36] == (11, 38, "Lunch")
    assert tm[9 * 3600 + 52 * 60 + 11] == (9, 52, "Morning")
    fact = warehouse.build_fact(lines, orders, sku)
    rows = {r.line_id: r for r in fact.collect()}
    assert rows[2].total_price == decimal.Decimal("40.50") and rows[2].product_id == "mex"
    assert rows[5].unit_price == decimal.Decimal("16.00")
    counts = {r.table_name: r.row_count for r in
              warehouse.row_counts({"fact": fact, "dim_sku": sku, "dim_product": prod}).collect()}
    assert counts == {"fact": 5, "dim_sku": 6, "dim_product": 2}
    unsold = [r.sku_id for r in audit.unsold_skus(sku, prod, fact).collect()]
    assert sorted(unsold) == ["bbq_s", "mex_xxl"]
    low = sales.low_sellers(prod, fact, max_units=4).collect()
    assert [(r.product_id, r.total_quantity) for r in low] == [("bbq", 3)]


def test_tables_create_append_and_report(spark, tmp_path):
    db = "tallystar_test"
    created = tables.create_schema(spark, db, location=str(tmp_path / "wh"))
    assert "fact_sales" in created
    sku = spark.createDataFrame([("a_s", "a", "S", decimal.Decimal("9.50"))],
                                "sku_id string, product_id string, size string, price decimal(6,2)")
    tables.write_table(sku, f"{db}.dim_sku", mode="append")
    tables.write_table(sku, f"{db}.dim_sku", mode="append")
    assert tables.table(spark, f"{db}.dim_sku").count() == 2
    tables.write_table(sku, f"{db}.dim_sku", mode="overwrite")
    assert tables.table(spark, f"SELECT count(*) AS n FROM {db}.dim_sku").first().n == 1
    names = {r.table_name for r in tables.list_tables(spark, db).collect()}
    assert {"dim_sku", "fact_sales", "dim_date"} <= names
    out = tmp_path / "report"
    tables.write_report(sku, str(out), order_by=["sku_id"])
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_literal_rows_and_calendar(spark):
    lit = literal_rows(spark, [("x", 1)], "k string, v int")
    assert lit.first().v == 1
    s = spark.createDataFrame([(dt.date(2020, 2, 27),), (dt.date(2020, 3, 2),)], "date_id date")
    assert [r.date_id.day for r in calendar_of(s).orderBy("date_id").collect()] == [27, 28, 29, 1, 2]


def test_load_job_end_to_end(spark, tmp_path):
    from tallystar.plans import warehouse_job

    d = _raw(tmp_path)
    db = "tallystar_load"
    counts = {r.table_name: r.row_count for r in
              warehouse_job.load_from_csv(spark, str(d), db, location=str(tmp_path / "wh")).collect()}
    assert counts == {"fact_sales": 5, "dim_sku": 6, "dim_product": 2, "dim_date": 2, "dim_time": 3}
    # Re-running the load in overwrite mode is idempotent; append doubles the fact.
    warehouse_job.load_from_csv(spark, str(d), db)
    assert spark.table(f"{db}.fact_sales").count() == 5
    star = warehouse_job.star_from_catalog(spark, db)
    by_hour = {r.hour: (r.total_orders, r.total_units, r.total_revenue)
               for r in sales.sales_by_hour(star.fact, star.dim_time).collect()}
    assert by_hour[11] == (1, 3, 57.25)
    assert by_hour[9] == (1, 4, 68.75)
    ranking = {r.name: (r.volume_rank, r.revenue_rank) for r in
               sales.menu_ranking(star.fact, star.dim_product).collect()}
    assert ranking == {"The Mexicana": (1, 1), "The BBQ Pizza": (2, 2)}
    spark.sql(f"DROP DATABASE {db} CASCADE")
