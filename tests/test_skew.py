"""Hot keys: one order holding a third of all lines must not change results
(dedup happens map-side before any per-order work)."""

import itertools
import random

from tallystar.operators import basket, composition


def test_hot_order_pairs_and_sizes(spark):
    rnd = random.Random(3)
    products = [f"p{i:02d}" for i in range(12)]
    rows = []
    for o in range(1, 301):                       # ordinary orders: 1-4 lines
        for p in rnd.sample(products, rnd.randint(1, 4)):
            rows.append((o, p))
    hot = [(999, rnd.choice(products)) for _ in range(len(rows) // 2)]   # a third of all lines
    rows += hot
    fact = spark.createDataFrame(rows, "order_id long, product_id string").repartition(6)
    prod = spark.createDataFrame([(p, f"The {p}", "c" + str(int(p[1:]) % 2)) for p in products],
                                 "product_id string, name string, category string")
    items = basket.order_items(fact, prod)
    got = {(r.product_id_a, r.product_id_b): r.orders_with_both
           for r in basket.pair_support(items, prod).collect()}
    baskets = {}
    for o, p in rows:
        baskets.setdefault(o, set()).add(p)
    want = {}
    for ps in baskets.values():
        for a, b in itertools.combinations(sorted(ps), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    assert got == want
    sizes = {r.total_items: r.order_count for r in composition.order_size_distribution(fact).collect()}
    assert sizes[len(baskets[999])] >= 1
    assert sum(sizes.values()) == len(baskets)
