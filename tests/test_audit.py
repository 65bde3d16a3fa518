"""Audit operators on hand-made frames (NULLs, orphans, duplicates, levels)."""

from tallystar.operators import audit, sales


def test_nulls_orphans_duplicates(spark):
    fact = spark.createDataFrame(
        [(1, 1, "a", 2), (2, 1, None, 1), (2, 1, "z", None)],
        "order_id long, line_no int, sku_id string, quantity int")
    dim = spark.createDataFrame([("a",), ("b",)], "sku_id string")
    nulls = {(r.table_name, r.column_name): (r.null_count, r.status) for r in
             audit.audit_nulls({"f": fact, "d": dim}, [("f", "sku_id"), ("f", "quantity"), ("d", "sku_id")])
             .collect()}
    assert nulls == {("f", "sku_id"): (1, "FAIL"), ("f", "quantity"): (1, "FAIL"), ("d", "sku_id"): (0, "PASS")}
    orphans = audit.audit_orphans(fact, [("f->d", dim, "sku_id")]).first()
    assert orphans.orphaned_rows == 2 and orphans.status == "FAIL"
    dup = audit.duplicate_keys(fact, ["order_id", "line_no"]).first()
    assert (dup.total_rows, dup.unique_ids, dup.duplicates) == (3, 2, 1)


def test_order_by_levels_puts_unlisted_last(spark):
    df = spark.createDataFrame([("Dinner", 1), ("Brunch", 2), ("Morning", 3), (None, 4)],
                               "meal_period string, n int")
    got = [r.meal_period for r in audit.meal_period_levels(df).collect()]
    assert got == ["Morning", "Dinner", "Brunch"]


def test_rank_divergence_sign(spark):
    ranking = spark.createDataFrame([("The A", 1, 3), ("The B", 3, 1), ("The C", 2, 2)],
                                    "name string, volume_rank int, revenue_rank int")
    got = {r.short_name: (r.rank_divergence, r.direction) for r in sales.rank_divergence(ranking).collect()}
    assert got["B"] == (2, "earns above volume weight")
    assert got["A"] == (-2, "sells above revenue weight")
    assert got["C"][1] == "earns above volume weight"
