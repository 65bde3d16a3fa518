import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar import session
from tallystar.llm import op09_partenum as op9


def some_sets():
    rng = np.random.default_rng(6)
    pool = rng.integers(1, 1 << 63, 4000).astype(np.uint64)
    sizes = (0, 1, 3, 60, 180, 224, 225, 500, 0, 1700, 300)
    return pool, [np.unique(rng.choice(pool, n, replace=False)) for n in sizes]


@pytest.mark.parametrize("share", [0, 0.1, 1])
def test_signatures_do_not_depend_on_the_batch(share):
    pool, sets = some_sets()
    often = np.sort(pool[:int(len(pool) * share)])
    sigs, owner = op9.all_signatures(sets, often)
    for i, s in enumerate(sets):
        alone = op9.signatures(s, often)
        assert np.array_equal(np.sort(sigs[owner == i]), np.sort(alone)) and bool(len(alone)) == bool(len(s))
    assert op9.sketches_of(sets) == [op9.sketch(s) for s in sets]
    assert op9.set_ids(sets).tolist() == [int(op9.set_ids([s])[0]) for s in sets]


def test_one_reading_gives_sets_and_counts(spark, monkeypatch):
    monkeypatch.setattr(op9, "SLAB", 200)
    texts = [f"u{i} v{i} w{i} x{i} y{i} a b c d e" for i in range(60)] + [None, "", "one two"]
    df = spark.createDataFrame([(None if i == 5 else f"k{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    made = op9.counted_sets(df, "doc_id", "text")
    rows = {r["key"]: r["n"] for r in op9.set_rows(made).collect()}
    assert len(rows) == 63 and rows["k0"] == 6 and rows[None] == 6 and [rows[f"k{i}"] for i in (60, 61, 62)] == [0, 0, 1]
    assert op9.shingle_sets([b"a b c d e"])[0].tolist() == op9.frequent_of(made, 63).tolist()


def test_small_tables_are_few_files(spark, monkeypatch):
    most = 4 * spark.sparkContext.defaultParallelism
    df = spark.range(1000).repartition(most + 50)
    assert session.few_files(df).rdd.getNumPartitions() == most
    assert session.few_files(df, 10 * (most + 5), 10).rdd.getNumPartitions() == most + 5
    written = []
    real = op9.cut_lineage

    def cut(frame):
        out = real(frame)
        written.append(sum(f.startswith("part-") for f in os.listdir(session.SCRATCH[-1].removeprefix("file:"))))
        return out

    monkeypatch.setattr(op9, "cut_lineage", cut)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", most + 60)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        texts = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(w), (F.col("id") / 2).cast("int")) for w in "abcdefg"]).alias("text"))
        sets = op9.cut_lineage(op9.with_sets(texts, "doc_id", "text"))
        pairs = sets.select(F.col("set").alias("a"), F.col("set").alias("b")).distinct()
        assert op9.verify(pairs, texts, op9.distinct_sets(sets), "doc_id", "text").count() == 200
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(written) == 4 and max(written) <= most
