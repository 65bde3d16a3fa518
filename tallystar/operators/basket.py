"""Basket analysis and cannibalisation screening.

Pairs are oriented by product name (the reference keeps ``name_a <
name_b``); products are numbered in that order and pairs are counted sparsely
(see ``operators.cooccur``). Where a smallest support is asked for, products
that few orders hold go before any pair is formed: a pair is never more
frequent than its rarer product. Item-level tables (support per product, the
product index) carry no broadcast hint, so Spark's size check (static, then
AQE runtime) decides and a large catalogue falls back to a shuffled join. The
order-level work is shuffled by order id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.scalar import exact_round, strip_the
from tallystar.operators.composition import order_products
from tallystar.operators.cooccur import pair_comoments, pair_counts, pearson
from tallystar.session import cut_lineage, deal_count, dealt


def order_items(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per (order, product), then names."""
    return (order_products(fact)
            .join(dim_product.select("product_id", "name", "category"), "product_id")
            .select("order_id", "product_id", "name", "category"))


def total_baskets(items: DataFrame) -> DataFrame:
    return items.agg(F.countDistinct("order_id").alias("n_orders"))


def item_support(items: DataFrame) -> DataFrame:
    return (items.groupBy("product_id", "name", "category")
            .agg(F.count(F.lit(1)).alias("orders_with_item")))


def product_index(dim_product: DataFrame) -> DataFrame:
    """Products numbered by (name, id); the window runs over the menu only."""
    w = Window.orderBy("name", "product_id")
    return dim_product.select("product_id", "name", "category",
                              (F.row_number().over(w) - 1).cast("long").alias("idx"))


def _label_pairs(pairs: DataFrame, index: DataFrame) -> DataFrame:
    a = index.select(F.col("idx").alias("item_a"), F.col("product_id").alias("product_id_a"),
                     F.col("name").alias("name_a"), F.col("category").alias("category_a"))
    b = index.select(F.col("idx").alias("item_b"), F.col("product_id").alias("product_id_b"),
                     F.col("name").alias("name_b"), F.col("category").alias("category_b"))
    return pairs.join(a, "item_a").join(b, "item_b")


def pair_support(items: DataFrame, dim_product: DataFrame, min_support: int = 1) -> DataFrame:
    """Orders containing both products, for every pair in ``min_support`` orders or more.

    The (order, product) rows are written once: their number tells in how many
    partitions orders are dealt, so the sort of a task does not grow with them.
    """
    items = cut_lineage(items.select("order_id", "product_id"))
    return _pairs_of(items, dim_product, min_support, deal_count(items))


def _pairs_of(rows: DataFrame, dim_product: DataFrame, min_support: int, parts: int | None) -> DataFrame:
    index = product_index(dim_product)
    if min_support > 1:
        frequent = rows.groupBy("product_id").count().where(F.col("count") >= min_support)
        rows = rows.join(frequent.select("product_id"), "product_id", "left_semi")
    rows = rows.join(index.select("product_id", "idx"), "product_id").select("order_id", "idx")
    pairs = pair_counts(rows, ["order_id"], "idx", parts)
    if min_support > 1:
        pairs = pairs.where(F.col("n") >= min_support)
    return (_label_pairs(pairs, index)
            .select("product_id_a", "name_a", "category_a", "product_id_b", "name_b",
                    "category_b", F.col("n").alias("orders_with_both")))


def _wide(count: str):
    """A count as DECIMAL(17,0): products of two stay exact past BIGINT."""
    return F.col(count).cast("decimal(17,0)")


def pair_lift(items: DataFrame, dim_product: DataFrame, min_support: int = 50) -> DataFrame:
    """lift = n_ab * N / (n_a * n_b), rounded half-even to 3 decimals, support >= min.

    The (order, product) rows are written once; supports, the number of orders
    N (a one-row scalar) and the pairs of frequent products read them, so the
    fact is scanned once. Large ones are dealt by order to count the orders too.
    """
    items = cut_lineage(items.select("order_id", "product_id"))
    parts = deal_count(items)
    pairs = _pairs_of(items, dim_product, min_support, parts)
    support = items.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    n_orders = dealt(items.select("order_id"), parts, "order_id").agg(F.countDistinct("order_id").cast("decimal(17,0)")).scalar()
    for side in "ab":
        pairs = pairs.join(support.select(F.col("product_id").alias(f"product_id_{side}"), F.col("n").alias(f"orders_{side}")),
                           f"product_id_{side}")
    return (pairs.withColumn("lift", exact_round(_wide("orders_with_both") * n_orders,
                                                 _wide("orders_a") * _wide("orders_b"), 3, "half_even"))
            .select("product_id_a", "name_a", "category_a", "product_id_b", "name_b", "category_b",
                    "orders_with_both", "orders_a", "orders_b", "lift")
            .orderBy(F.desc("lift"), "name_a", "name_b"))


def top_pairs(lift: DataFrame, n: int = 15) -> DataFrame:
    """Top ``n`` pairs by lift, keeping ties (so possibly more than n rows).

    The n-th value (a distributed top-n) cuts the pair table first; the rank
    window sees only the rows at or above it.
    """
    lift = cut_lineage(lift)
    least = lift.select("lift").orderBy(F.desc_nulls_last("lift")).limit(n).agg(F.min("lift")).scalar()
    w = Window.orderBy(F.desc("lift"))
    return (lift.filter(F.col("lift") >= least).withColumn("lift_rank", F.rank().over(w)).filter(F.col("lift_rank") <= n)
            .withColumn("pair_label", F.concat(strip_the("name_a"), F.lit(" + "), strip_the("name_b")))
            .select("pair_label", "name_a", "name_b", "orders_with_both", "lift",
                    F.col("lift_rank").cast("int").alias("lift_rank"))
            .orderBy(F.desc("lift"), "pair_label"))


def within_category_lift(lift: DataFrame, min_support: int = 30,
                         max_lift: float | None = None) -> DataFrame:
    out = lift.filter((F.col("category_a") == F.col("category_b"))
                      & (F.col("orders_with_both") >= min_support))
    if max_lift is not None:
        out = out.filter(F.col("lift") < max_lift)
    return (out.select(F.col("category_a").alias("category"), "name_a", "name_b",
                       "orders_with_both", "lift")
            .orderBy("category", "lift", "name_a", "name_b"))


def daily_units(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (fact.groupBy("date_id", "product_id")
            .agg(F.sum("quantity").cast("long").alias("daily_qty"))
            .join(dim_product.select("product_id", "name", "category"), "product_id")
            .select("date_id", "product_id", "name", "category", "daily_qty"))


def daily_correlation(daily: DataFrame, dim_product: DataFrame, min_days: int = 100) -> DataFrame:
    """Pearson correlation of daily units for same-category pairs over shared days.

    Groups are (date, category), so only same-category products meet; the
    centred co-moments come from ``pair_comoments``.
    """
    index = product_index(dim_product)
    rows = daily.select("date_id", "category", "product_id", "daily_qty").join(
        index.select("product_id", "idx"), "product_id")
    m = pair_comoments(rows, ["date_id", "category"], "idx", "daily_qty")
    r = pearson(F.col("m2_a"), F.col("m2_b"), F.col("c_ab"))
    return (_label_pairs(m.filter(F.col("n") >= min_days), index)
            .select(F.col("category_a").alias("category"), "name_a", "name_b",
                    F.col("n").alias("shared_days"), F.bround(r, 3).alias("correlation"))
            .orderBy("category", "correlation", "name_a", "name_b"))


def candidates(within: DataFrame, corr: DataFrame, max_lift: float = 1.0,
               max_corr: float = 0.05, mode: str = "any") -> DataFrame:
    """Pairs with low lift and/or low correlation (the reference uses OR)."""
    j = within.select("category", "name_a", "name_b", "lift").join(
        corr.select("category", "name_a", "name_b", "correlation"),
        ["category", "name_a", "name_b"])
    lo_l, lo_c = F.col("lift") < max_lift, F.col("correlation") < max_corr
    cond = (lo_l | lo_c) if mode == "any" else (lo_l & lo_c)
    return j.filter(cond).orderBy("lift", "correlation", "name_a", "name_b")
