import numpy as np
import pandas as pd
import pytest

from tallystar.llm import components as comp
from tallystar.llm import op09_partenum as op9


def brute(links):
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    while True:
        new = dict(root)
        for a, b in links:
            low = min(new[a], new[b])
            new[a] = new[b] = low
        if new == root:
            return root
        root = new


def some_links():
    rng = np.random.default_rng(11)
    links = [(int(a), int(b)) for a, b in rng.integers(-400, 400, (300, 2)) if a != b]
    return links + links[:20] + [(k, k + 1) for k in range(1000, 1080)] + [(5000, k) for k in range(4000, 4060)]


@pytest.mark.parametrize("held", [7, 1 << 19])
def test_components_joined_in_tasks_and_by_rounds(spark, monkeypatch, held):
    monkeypatch.setattr(comp, "JOINED", held)
    links = some_links()
    df = spark.createDataFrame([*links, (9, 9), (None, 3)], "a long, b long").repartition(5)
    found = [tuple(r) for r in comp.components(df).collect()]
    assert len(found) == len(dict(found)) and dict(found) == brute(links)
    assert comp.components(df.where("a > 1000000")).count() == 0


def test_few_links_take_few_jobs(spark):
    df = op9.cut_lineage(spark.createDataFrame(some_links(), "a long, b long"))
    spark.sparkContext.setJobGroup("few links", "")
    try:
        comp.components(df)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few links")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 12                     # each round of stars takes more than that


@pytest.mark.parametrize("width", [1, 2, 8, 37])
def test_comparison_of_half_sketches_first_misses_nothing(width):
    rng = np.random.default_rng(width)
    base = rng.integers(0, 1 << 63, width).astype(np.uint64)
    sketches = np.stack([base ^ np.where(rng.random(width) < .2, np.uint64(1) << rng.integers(0, 63, width).astype(np.uint64), np.uint64(0))
                         for _ in range(150)])
    sketches[::3] = rng.integers(0, 1 << 63, (50, width)).astype(np.uint64)
    n, roots = rng.integers(1 + 4 * width, 8 + 6 * width, 150), rng.integers(0, 40, 150)

    def ok(a, b):
        far = int(np.bitwise_count(sketches[a] ^ sketches[b]).sum())
        return (roots[a] != roots[b] and 175 * far <= 25 * (n[a] + n[b]) and 100 * min(n[a], n[b]) >= 75 * max(n[a], n[b])), far

    every, left, right = np.arange(150), np.arange(70), np.arange(70, 150)
    for first, second in ((every, every), (left, right), (left[:0], right)):
        x, y, far = op9._compare(n, roots, sketches, first, second)
        want = {(a, b): ok(a, b)[1] / (n[a] + n[b]) for a in first.tolist() for b in second.tolist()
                if (first is not second or a < b) and ok(a, b)[0]}
        assert dict(zip(zip(x.tolist(), y.tolist()), far.tolist())) == want and len(x) == len(want)


@pytest.mark.parametrize("size", [1, 3, 50])
def test_runs_of_rows_go_over_batches(size):
    grp = np.repeat([4, 5, 5, 9, 2], [3, 1, 6, 2, 8])
    pdf = pd.DataFrame({"grp": grp, "p": np.repeat([0, 1], [6, 14]), "x": np.arange(20)})
    runs = list(op9._groups((pdf.iloc[a:a + size] for a in range(0, 20, size)), ["grp", "p"]))
    assert [(int(r["grp"][0]), r["x"].tolist()) for r in runs] == [
        (4, [0, 1, 2]), (5, [3, 4, 5]), (5, [6, 7, 8, 9]), (9, [10, 11]), (2, list(range(12, 20)))]
