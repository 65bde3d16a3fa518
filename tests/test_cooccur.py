"""Sparse pair statistics against a brute-force self-join."""

import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallystar.operators import basket, cooccur


def _brute(rows):
    by_group = {}
    for g, i, v in rows:
        by_group.setdefault(g, {})[i] = v
    out = {}
    for items in by_group.values():
        for a, b in itertools.combinations(sorted(items), 2):
            out.setdefault((a, b), []).append((items[a], items[b]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("wide", [4, 1024])
def test_pairs_equal_self_join(spark, seed, wide, monkeypatch):
    rnd = random.Random(seed)
    rows = set()
    for g in range(300):
        k = rnd.choice([1, 2, 3, 8, 20])  # includes one large basket per few groups
        for i in rnd.sample(range(25), k):
            rows.add((g, i))
    data = [(g, i, float(rnd.randint(0, 9))) for g, i in sorted(rows)]
    # Small bounds: groups are split into block pairs, chunks, folds and Arrow batches.
    monkeypatch.setattr(cooccur, "WIDE", wide)
    monkeypatch.setattr(cooccur, "PAIRS", 50)
    monkeypatch.setattr(cooccur, "HELD", 70)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.createDataFrame(data, "g long, i long, v double")
        got = {(r.item_a, r.item_b): r for r in cooccur.pair_comoments(df, ["g"], "i", "v").collect()}
        counts = {(r.item_a, r.item_b): r.n for r in cooccur.pair_counts(df, ["g"], "i").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = _brute(data)
    assert set(got) == set(want) and counts == {k: len(v) for k, v in want.items()}
    for k, w in want.items():
        x = np.array(w)
        d = x - x.mean(0)
        assert got[k].n == len(w)
        assert np.allclose([got[k].mean_a, got[k].mean_b], x.mean(0))
        assert np.allclose([got[k].m2_a, got[k].m2_b, got[k].c_ab], [*(d * d).sum(0), (d[:, 0] * d[:, 1]).sum()], atol=1e-9)


def test_large_catalogue_and_one_wide_order(spark):
    rnd = random.Random(5)
    rows = [(1, i) for i in rnd.sample(range(20000), 5000)]
    rows += [(g, i) for g in range(2, 3000) for i in rnd.sample(range(20000), rnd.randint(1, 6))]
    items = spark.createDataFrame([(g, f"p{i}") for g, i in rows], "order_id long, product_id string")
    menu = spark.createDataFrame([(f"p{i}", f"The {i:05d}", "c") for i in range(20000)],
                                 "product_id string, name string, category string")
    pairs = cooccur.pair_counts(spark.createDataFrame(rows, "g long, i long"), ["g"], "i")
    assert pairs.agg(F.sum("n")).first()[0] == sum(
        len(own) * (len(own) - 1) // 2 for _, own in itertools.groupby(sorted(rows), lambda r: r[0]) for own in [list(own)])
    got = {(r.product_id_a, r.product_id_b): r.orders_with_both for r in basket.pair_support(items, menu, 3).collect()}
    want = {}
    for _, own in itertools.groupby(sorted(rows), lambda r: r[0]):
        own = sorted(i for _, i in own)
        if len(own) < 5000:
            for a, b in itertools.combinations(own, 2):
                want[a, b] = want.get((a, b), 0) + 1
    wide = {i for g, i in rows if g == 1}
    want = {(f"p{a}", f"p{b}"): n + (a in wide and b in wide) for (a, b), n in want.items()}
    assert got == {k: n for k, n in want.items() if n >= 3}


def test_rare_products_go_before_pairing(spark):
    items = spark.createDataFrame([(g, f"p{i}") for g in range(60) for i in (0, 1, 100 + g)], "order_id long, product_id string")
    menu = spark.createDataFrame([(f"p{i}", f"The {i}", "c") for i in [0, 1, *range(100, 160)]],
                                 "product_id string, name string, category string")
    seen = []
    real = basket.pair_counts
    basket.pair_counts = lambda rows, *a: (seen.append(rows.select("idx").distinct().count()), real(rows, *a))[1]
    try:
        assert [r.orders_with_both for r in basket.pair_lift(items, menu, 50).collect()] == [60]
    finally:
        basket.pair_counts = real
    assert seen == [2]


def test_no_window_over_all_pairs(spark):
    items = spark.createDataFrame([(1, "a"), (1, "b")], "order_id long, product_id string")
    menu = spark.createDataFrame([("a", "A", "x"), ("b", "B", "x")], "product_id string, name string, category string")
    plan = basket.pair_lift(items, menu, 1)._jdf.queryExecution().executedPlan().toString()
    # One window numbers the menu; no other runs without PARTITION BY.
    assert all("row_number" in w for w in re.findall(r"Window \[[^\n]*", plan) if "windowspecdefinition(order_id" not in w)


def test_correlation_of_large_values_with_a_small_spread(spark):
    rnd = np.random.default_rng(0)
    x = 1e9 + rnd.normal(0, 1, 800)
    y = 1e9 + 0.5 * (x - 1e9) + rnd.normal(0, 1, 800)
    pdf = pd.DataFrame({"g": np.repeat(np.arange(800), 2), "i": np.tile([0, 1], 800), "v": np.column_stack([x, y]).ravel()})
    m = cooccur.pair_comoments(spark.createDataFrame(pdf).repartition(7), ["g"], "i", "v")
    r = m.select(cooccur.pearson(F.col("m2_a"), F.col("m2_b"), F.col("c_ab")).alias("r")).first().r
    assert abs(r - np.corrcoef(x, y)[0, 1]) < 1e-6
    flat = spark.createDataFrame([(g, i, 5.0) for g in range(9) for i in (0, 1)], "g int, i long, v double")
    assert cooccur.pair_comoments(flat, ["g"], "i", "v").select(
        cooccur.pearson(F.col("m2_a"), F.col("m2_b"), F.col("c_ab"))).first()[0] is None


def test_lift_is_symmetric_and_matches_formula(spark):
    items = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "c"), (4, "b"), (5, "c")],
        "order_id long, product_id string")
    prod = spark.createDataFrame([("a", "The A", "x"), ("b", "The B", "x"), ("c", "The C", "y")],
                                 "product_id string, name string, category string")
    items = items.join(prod, "product_id")
    lift = {(r.product_id_a, r.product_id_b): r.lift
            for r in basket.pair_lift(items, prod, min_support=1).collect()}
    # N=5 orders; a in 3, b in 3, ab in 2 -> 2*5/9 = 1.111
    assert lift[("a", "b")] == 1.111
    assert lift[("b", "c")] == round(1 * 5 / (3 * 2), 3)
    assert ("b", "a") not in lift
