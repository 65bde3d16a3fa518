"""Plan-shape rules, checked on every registered query (materialised star).

* no cartesian product / nested-loop join anywhere;
* the fact scan reads only the columns a query needs;
* one-pass gap filling has no calendar self-join.
"""

import re

import pytest

from tallystar.plans import warehouse_job
from tallystar.plans.registry import load_all

QUERIES = load_all()


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    warehouse_job.build(spark, sf_dir)
    yield
    warehouse_job.forget(spark, sf_dir)


def _plan(spark, sf_dir, name):
    return QUERIES[name].build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian(spark, sf_dir, built, name):
    plan = _plan(spark, sf_dir, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,cols", [
    ("sales_by_hour", {"order_id", "time_id", "quantity", "total_price"}),
    ("audit_quantity_stats", {"quantity"}),
    ("order_items", {"order_id", "product_id"}),
    ("daily_product_units", {"date_id", "product_id", "quantity"}),
])
def test_fact_scan_is_pruned(spark, sf_dir, built, name, cols):
    plan = _plan(spark, sf_dir, name)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    fact = [s for s in schemas if any(c in s for c in ("order_id", "quantity"))]
    assert fact, plan
    for s in fact:
        got = set(re.findall(r"(\w+):", s))
        assert got <= cols, (name, got)


def test_gap_fill_has_no_join(spark, sf_dir, built):
    plan = _plan(spark, sf_dir, "gap_fill_dow_median")
    assert "Join" not in plan
    assert "Generate" in plan


def test_materialised_star_matches_lazy(spark, sf_dir):
    names = ["sales_by_hour", "menu_ranking", "pair_lift", "gap_fill_dow_median", "audit_orphans"]
    lazy = {n: sorted(map(tuple, QUERIES[n].build(spark, sf_dir).collect())) for n in names}
    warehouse_job.build(spark, sf_dir)
    try:
        for n in names:
            assert sorted(map(tuple, QUERIES[n].build(spark, sf_dir).collect())) == lazy[n], n
    finally:
        warehouse_job.forget(spark, sf_dir)


@pytest.mark.parametrize("name", ["category_performance", "category_performance_subquery", "size_performance",
                                  "size_performance_subquery", "audit_size_values", "audit_zero_days",
                                  "audit_menu_coverage"])
def test_fact_is_aggregated_before_joins(spark, sf_dir, built, name):
    """Without broadcast joins, no raw fact row is shuffled on a dimension key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(spark, sf_dir, name).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\((product_id|sku_id|date_id)#", line):
            below = next(x for x in lines[i + 1:] if "HashAggregate" in x or "FileScan" in x)
            assert "HashAggregate" in below or "/fact" not in below, (name, line, below)
