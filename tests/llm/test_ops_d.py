"""Operators 7 and 9: clashing names, repeated and null keys, decoding by the query."""

import itertools
import random

import numpy as np

from tallystar.llm import batches, op07_gumbel_pieces, op09_partenum
from tallystar.llm.names import free_name


def test_free_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`__ROW` int, __row_ int, x int")
    assert free_name(df, "__row") == "__row__" and free_name(df, "y") == "y"


def test_release_ends_quietly():
    assert list(batches.tidy(lambda b: (x + 1 for x in b))([1, 2])) == [2, 3]


def test_encode_keeps_clashing_columns_and_checks_decoding(spark):
    texts = ["one two", None, "", "a\u2581b \u2581 \u00e9\U0001f600", "  spaced  out ", "x" * 3000]
    df = spark.createDataFrame([(k, t, "keep", k + 0.5, [k]) for k, t in enumerate(texts)],
                               "doc_id long, text string, __text string, __seed double, samples array<long>")
    out = op07_gumbel_pieces.encode(df, k=3, check="ok")
    assert out.columns == ["doc_id", "text", "__text", "__seed", "samples", "ok"]
    for r in out.collect():
        assert r["__text"] == "keep" and r["__seed"] == r.doc_id + 0.5
        assert r.ok is (None if r.text is None else True)
    raw = op07_gumbel_pieces.load_vocabulary()["raw"]
    assert not op07_gumbel_pieces._round_trips(
        raw, op07_gumbel_pieces._as_arrow([[(np.zeros(0, np.int32), 0.0, 0.0)]], len(raw), None), ["one two"])[0].as_py()


def test_query_decodes_every_document(spark, sf_dir):
    rows = op07_gumbel_pieces.query(spark, sf_dir).select("n_samples", "round_trip").collect()
    assert len(rows) == 200 and all(r.round_trip for r in rows)


def _words(rng, n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def test_keep_one_by_component_not_by_key(spark):
    rng = random.Random(1)
    a, b, c = (" ".join(_words(rng, 60)) for _ in range(3))
    near = a.replace(a.split()[30], "changed")
    rows = [(2, a), (2, b), (5, near), (None, c), (None, b + " tail"), (7, c), (7, c), (3, None), (4, ""), (4, "")]
    df = spark.createDataFrame([(k, t, k, t, 1) for k, t in rows], "doc_id long, text string, __row long, component string, copies int")
    kept = op09_partenum.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(2, a), (2, b), (7, c), (3, None), (4, ""), (4, "")]
    assert got == sorted(want, key=str)
    assert all(r["__row"] == r.doc_id for r in kept.collect())
    assert op09_partenum.keep_one(df.limit(0)).count() == 0


def test_group_of_near_copies_costs_one_pair_a_member(spark, monkeypatch):
    """Pairs that pass the bounds grow with the members, not their square."""
    def run(m):
        rng = random.Random(m)
        base = _words(rng, 160)
        texts = []
        for _ in range(m):
            own = list(base)
            for at in rng.sample(range(160), 1):
                own[at] = f"x{rng.randrange(10 ** 9)}"
            texts.append(" ".join(own))
        seen = []
        real = op09_partenum.possible
        monkeypatch.setattr(op09_partenum, "possible", lambda *x: seen.append(real(*x)) or seen[-1])
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        parts = {}
        for r in op09_partenum.link(df).collect():
            parts.setdefault(r.component, set()).add(r.key)
        monkeypatch.setattr(op09_partenum, "possible", real)
        sets = [s.tolist() for s in op09_partenum.shingle_sets([t.encode() for t in texts])]
        root = list(range(m))
        for i, j in itertools.combinations(range(m), 2):
            x, y = set(sets[i]), set(sets[j])
            if 100 * len(x & y) >= 75 * len(x | y):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
        want = {}
        for k, r in enumerate(root):
            want.setdefault(r, set()).add(k)
        assert sorted(map(sorted, parts.values())) == sorted(map(sorted, want.values()))
        return sum(p.count() for p in seen)
    few, many = run(40), run(160)
    assert many <= 8 * few, (few, many)


def test_pieces_that_are_no_text_do_not_round_trip():
    raw = [b" a", b"\xff", "é".encode()]
    rows = [[(np.array(ids, np.int32), 0.0, 0.0)] for ids in ([0, 1], [0, 2], [0, 3 + 0xE9])]
    samples = op07_gumbel_pieces._as_arrow(rows, 3, np.array([0] * 0xA9 + [1] + [0] * 86, np.int32))
    assert op07_gumbel_pieces._round_trips(raw, samples, ["a", "aé", "a"]).to_pylist() == [False, True, False]
    assert samples.flatten().field("ids").to_pylist() == [[0, 1], [0, 2], [0, 0, 1]]
