import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import op09_partenum as op9
from tallystar.llm.hashing import BASE, mix64


def test_sets_short_of_groups_meet_whatever_the_order():
    # All shared shingles in part 0 of 36 groups, what differs in parts 1 and 2.
    h = np.random.default_rng(4).integers(1, 1 << 63, 200_000).astype(np.uint64)
    spot = mix64(h + np.uint64(128 * int(BASE) & (1 << 64) - 1)) % np.uint64(128 * op9.N2)
    pick = lambda part, each: np.concatenate([h[spot == g * op9.N2 + part][:each] for g in range(36)])
    shared = pick(0, 6)
    x, y = np.unique(np.concatenate((shared, pick(1, 1)))), np.unique(np.concatenate((shared, pick(2, 1))))
    assert op9.bands(len(x)) == [128] and op9.similar(x, y)
    for often in (np.zeros(0, np.uint64), np.sort(shared), np.sort(shared[::2])):
        assert set(op9.signatures(x, often).tolist()) & set(op9.signatures(y, often).tolist())


def test_frequent_shingles_are_counted_over_all_documents(spark, monkeypatch):
    texts = [f"u{i} v{i} w{i} x{i} y{i}" + (" a b c d e" if i % 40 == 0 else "") + (" f g h i j" if i % 150 == 0 else "")
             for i in range(400)]
    monkeypatch.setattr(op9, "SLAB", 300)
    monkeypatch.setattr(op9, "SLAB_DOCUMENTS", 100)
    df = spark.createDataFrame([(t,) for t in texts + [None, ""]], "text string").repartition(4)
    found = set(op9.frequent_shingles(df, "text").tolist())
    whole = {s for t in (b"a b c d e",) for s in op9.shingle_sets([t])[0].tolist()}
    rare = set(op9.shingle_sets([b"f g h i j"])[0].tolist())
    assert whole <= found and not rare & found              # in 10 and in 3 of 402
    assert not hasattr(op9, "SAMPLE_DOCUMENTS")


def test_closest_members_go_first(spark, monkeypatch):
    far = np.array([3., 1., 2., 5.])
    x, y = np.array([0, 0, 0, 3]), np.array([1, 2, 3, 4])
    assert op9._closest(x, y, far, 1).tolist() == [True, True, True, True]
    assert op9._closest(np.array([0, 1, 0]), np.array([1, 2, 2]), np.array([1., 2., 3.]), 1).tolist() == [True, True, False]


@pytest.mark.parametrize("few", [None, 2])
def test_across_brings_few_or_all(spark, few):
    rng, base = np.random.default_rng(2), [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(50):
        words = list(base)
        words[rng.integers(120)] = f"z{rng.integers(10 ** 9)}"
        texts.append((len(texts), " ".join(words)))
    sets = op9.cut_lineage(op9.with_sets(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text"))
    named = sets.select(F.lit(7).cast("long").alias("grp"), "set", F.col("set").alias("root"))
    n = op9.across(named, sets, few).count()
    assert n == 1225 if few is None else 25 <= n <= 100
