"""Operators 11, 12 and 13 against brute force and on edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallystar.llm import op11_whitening as whitening
from tallystar.llm import op12_phrases as phrases
from tallystar.llm import op13_segment_trees as trees

# --- 11: whitening ------------------------------------------------------------


def scatter_errors(x, lanes):
    s = whitening.Spectra(x.shape[1], lanes)
    s.push(x.astype(float))
    c = s.combined()
    centred = x - x.mean(0)
    m = centred.T @ centred
    back = c.rows[0].T @ np.diag(c.poles[0]) @ c.rows[0]
    apart = np.abs(c.rows[0] @ c.rows[0].T - np.eye(x.shape[1])).max()
    return np.abs(back - m).max() / max(1, np.abs(m).max()), apart, int(c.n[0])


@pytest.mark.parametrize("case", ["random", "few", "constant", "copied", "axes", "scales", "one"])
@pytest.mark.parametrize("lanes", [1, 4, 7])
def test_rank_one_updates_give_the_scatter(case, lanes):
    rng = np.random.default_rng(5)
    x = rng.integers(-60, 60, (150, 9))
    if case == "few":
        x = x[:5]
    elif case == "constant":
        x = np.full((20, 4), 7)
    elif case == "copied":
        x[:, 3], x[:, 7] = 0, x[:, 1]
    elif case == "axes":
        x = np.zeros((64, 8), int)
        x[np.arange(64), np.arange(64) % 8] = 9
    elif case == "scales":
        x[:, 0] *= 10 ** 8
    elif case == "one":
        x = x[:, :1]
    wrong, apart, n = scatter_errors(x, lanes)
    assert wrong < 1e-12 and apart < 1e-12 and n == len(x)


def test_secular_roots_interlace():
    rng = np.random.default_rng(1)
    poles = np.sort(rng.normal(size=(6, 12)) * 10.0 ** rng.integers(-6, 6, (6, 1)), axis=1)
    z2 = rng.random((6, 12)) ** 8
    root, diff = whitening._secular(poles, z2, np.ones((6, 12), bool))
    upper = np.concatenate((poles[:, 1:], (poles[:, -1] + z2.sum(1))[:, None]), 1)
    assert (diff[:, np.arange(12), np.arange(12)] < 0).all() and (root <= upper).all()
    value = 1 + (z2[:, None, :] / diff).sum(2)
    size = 1 + (z2[:, None, :] / np.abs(diff)).sum(2)
    assert (np.abs(value) <= 1e-13 * size).all()


def brute_whitening(vectors):
    x = {k: np.floor(256 * np.array(v, dtype=float)).astype(np.int64) for k, v in vectors}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, rows = np.linalg.eigh(centred.T @ centred / n)
    return x, n, s, values[::-1], rows[:, ::-1].T


def test_whitening_equals_dense_eigenvectors(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 6)) * [1, .8, .5, .3, .2, .1]
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, base[k % 7].tolist()) for k in range(100)]                 # a third of a kind
    bad = [(-1, None), (-2, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (-3, [math.nan] * 6), (-4, [math.inf] + [0.0] * 5),
           (-5, [])]
    monkeypatch.setattr(whitening, "ROWS_A_TASK", 20)
    (spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
     .write.parquet(f"{tmp_path}/embeddings.parquet"))
    got = whitening.query(spark, str(tmp_path)).collect()
    assert len(got) == 4 * len(rows)
    x, n, s, values, vectors = brute_whitening(rows)
    sign = {}
    for r in got:
        k = r.component - 1
        want = vectors[k] @ (x[r.vec_id] - s / n) / math.sqrt(values[k])
        if k not in sign and abs(want) > 1e-3:
            sign[k] = math.copysign(1, want * r.whitened)
        assert r.n == n and r.deviation == sum(int(n * a - b) ** 2 for a, b in zip(x[r.vec_id], s))
        if k in sign:
            assert r.whitened * sign[k] == pytest.approx(want, abs=1e-9)
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-10)
        assert r.identity_error < 1e-9


def test_whitening_edges(spark):
    df = spark.createDataFrame(
        [(1, [0.1, 0.2], "a"), (1, [0.1, 0.2], "a"), (None, [0.5, 0.25], "b"), (4, [9.0], "c"), (5, [], "d"),
         (6, [1e300, 1.0, 2.0], "e"), (7, [-1e300, 1.0, 2.5], "f")],
        "key long, embedding array<double>, whitening string")
    got = {(r.key, len(r.embedding)): r for r in whitening.whiten(df).collect()}
    assert whitening.whiten(df).columns == df.columns and len(whitening.whiten(df).collect()) == 7
    two = got[1, 2].whitening
    assert two.n == 2 and two.deviation == sum((2 * a - b) ** 2 for a, b in ((25, 153), (51, 115)))
    assert abs(abs(two.whitened[0]) - 1) < 1e-12 and two.whitened[1] is None and two.identity_error < 1e-12
    one = got[4, 1].whitening
    assert one.n == 1 and one.deviation == 0 and one.whitened == [None] and one.identity_error is None
    assert got[5, 0].whitening.whitened is None
    assert got[6, 3].whitening.n == 2 and got[6, 3].whitening.deviation is None
    assert whitening.whiten(df.limit(0)).count() == 0


def test_deviation_is_exact_beyond_doubles():
    x = np.array([[2 ** 40 + 1, 3], [5, -(2 ** 41)]])
    model = whitening.Model(2, 7, [3, -5], 2 ** 41, np.eye(2))
    assert model.wide
    assert [int(v) for v in (model.offsets(x) ** 2).sum(1)] == [
        sum((7 * int(a) - b) ** 2 for a, b in zip(row, (3, -5))) for row in x]


# --- 12: phrases ------------------------------------------------------------------


def random_texts(rng, n):
    kinds = ["ab", "a", "abcdefgh ijkl", "aé漢 "]
    return ["".join(rng.choice(kind) for _ in range(rng.randrange(250)))
            for kind in (rng.choice(kinds) for _ in range(n))] + ["a" * 3000, "ab" * 1500, "", "x"]


def plain_levels(data: bytes):
    """The levels of one text, symbol by symbol."""
    def low(a, b):
        return ((a ^ b) & -(a ^ b)).bit_length() - 1 if a != b else 0

    one = lambda v: int(phrases.mix64(np.array([v & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0])
    string = [int(phrases.CODES[b]) for b in data]
    base = int(phrases.BASE)
    while len(string) > 1:
        runs = []
        for s in string:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        names = [one(s + n * base) if n > 1 else s for s, n in runs]
        label = names
        for turn in range(4):
            label = [label[i] & 1 if i == 0 else 2 * low(label[i], label[i - 1])
                     + (label[i] >> low(label[i], label[i - 1]) & 1) for i in range(len(label))]
        for high in (5, 4, 3):
            label = [v if v != high else min({0, 1, 2} - {label[i - 1] if i else 6, label[i + 1] if i + 1 < len(label) else 6})
                     for i, v in enumerate(label)]
        cut = [0] + [i for i in range(1, len(label) - 1) if label[i - 1] < label[i] > label[i + 1]]
        string = [one(sum(one(v * base + k) for k, v in enumerate(names[a:b])) + b - a)
                  for a, b in zip(cut, [*cut[1:], len(names)])]
        yield string


def test_levels_equal_symbol_by_symbol():
    rng = random.Random(4)
    for text in random_texts(rng, 25):
        data = text.encode()
        if len(data) < 2:
            continue
        symbols, first = phrases.CODES[np.frombuffer(data, np.uint8)], np.arange(len(data)) == 0
        for want in plain_levels(data):
            symbols, first = phrases.next_level(symbols, first)
            assert symbols.tolist() == want
        assert len(symbols) == 1 and int(phrases.prints([data])[0][0]) == int(symbols[0])


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_prints_do_not_depend_on_pieces_or_neighbours(monkeypatch, piece):
    texts = [t.encode() for t in random_texts(random.Random(7), 80)]
    whole = phrases.prints(texts)
    monkeypatch.setattr(phrases, "PIECE", piece)
    cut = phrases.prints(texts)
    alone = [phrases.prints([t]) for t in texts]
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert all(a[0][0] == r and (a[1][0] == s).all() for a, r, s in zip(alone, *whole))
    back = phrases.from_strings(phrases.as_strings(*whole))
    assert (back[0] == whole[0]).all() and (back[1] == whole[1]).all()


def test_equal_substrings_share_interior_phrases():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    for _ in range(20):
        common = " ".join(rng.choice(words) for _ in range(60)).encode()
        found = []
        for _ in range(2):
            data = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))).encode() + common
            symbols, first = phrases.CODES[np.frombuffer(data, np.uint8)], np.arange(len(data)) == 0
            own = []
            for _ in range(3):
                symbols, first = phrases.next_level(symbols, first)
                own.append(set(symbols.tolist()))
            found.append(own)
        for level in range(3):
            inside = len(common) / 3 ** (level + 1)
            assert len(found[0][level] & found[1][level]) > 0.5 * inside - 12


def brute_edits(rows):
    """Rows of (doc_id, text), ids distinct: n_chars and edited digest."""
    order = sorted(rows, key=lambda r: -math.inf if r[0] is None else r[0], reverse=True)
    out = {}
    for k, (key, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[:len(text) - third] + after[:third]
        out[key] = (len(text), hashlib.sha256(changed.encode()).hexdigest())
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_edits_equal_brute_force(spark, parts):
    rng = random.Random(parts)
    texts = random_texts(rng, 120) + [None, " ".join(["word"] * 40000)]
    rows = [(k * 3, t) for k, t in enumerate(texts)] + [(None, "no key at all")]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, part int")
        got = phrases.edits(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute_edits(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    texts = dict(rows)
    whole = dict(zip(texts, phrases.as_strings(*phrases.prints([(t or "").encode() for t in texts.values()]))))
    for r in got:
        assert r.fingerprint == whole[r.doc_id] and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.n_chars < 3:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint


def test_edits_of_repeated_and_few_rows(spark):
    schema = "doc_id long, text string"
    one = phrases.edits(spark.createDataFrame([(1, "abcdef")], schema)).collect()
    assert [r.edited_sha256 for r in one] == [hashlib.sha256(b"abcdab").hexdigest()] and one[0].near_next == 1
    assert phrases.edits(spark.createDataFrame([], schema)).count() == 0
    same = phrases.edits(spark.createDataFrame([(1, "abcdef")] * 50 + [(2, "uvwxyz")] * 2, schema)).collect()
    assert len(same) == 52
    assert Counter(r.edited_sha256 == hashlib.sha256(b"uvwxuv").hexdigest() for r in same)[True] == 1


def test_likeness_follows_the_shared_text(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    texts = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(40)]
    a = phrases.prints([t.encode() for t in texts])
    b = phrases.prints([phrases.edited(t, u).encode() for t, u in zip(texts, texts[1:] + texts[:1])])
    near = phrases.likenesses(a, b)
    apart = phrases.likenesses(a, tuple(np.roll(x, 1, axis=0) for x in a))
    assert 0.55 < near.mean() < 0.75 and near.min() > 0.4 and apart.max() < 0.2
    df = phrases.fingerprints(spark.createDataFrame([(t,) for t in [*texts, None]], "text string"))
    rows = phrases.fingerprints(df, column="again").withColumn("near", phrases.likeness("fingerprint", "again")).collect()
    assert all(r.near == 1 for r in rows) and rows[-1].fingerprint == "0" * 16 + "fff" * 192


# --- 13: segment trees ----------------------------------------------------------------


def brute_audit(rows, min_docs, top):
    find = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+").findall
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = find("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups.add((lang, source))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = sorted(s for g, s in groups if g == lang)

        def price(c):
            size = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // size for t in kept}
        p = {s: price(counts[lang, s]) for s in own}
        q = price(sum((counts[lang, s] for s in own), Counter()))
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in own if o != s)
            out |= {(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(pairs)}
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(terms[:top])}
    return out


@pytest.mark.parametrize("leaves", [4, 4096])
def test_audit_equals_brute_force(spark, monkeypatch, leaves):
    rng = random.Random(leaves)
    words = ["".join(rng.choice("abcXYZé漢") for _ in range(rng.randrange(1, 4))) for _ in range(120)]
    rows = [(" ".join(rng.choice(words[:rng.randrange(1, 120)]) for _ in range(rng.randrange(60))),
             rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", None, "z"])) for _ in range(150)]
    rows += [(None, "en", "quiet"), ("", "xx", "p"), ("1 2 3", "xx", "q"), ("same same", "one", "only")] + [rows[0]] * 5
    rows.append(("Zz " * 5000 + "word", "en", "a"))
    monkeypatch.setattr(trees, "LEAVES", leaves)
    monkeypatch.setattr(trees, "PAIR_CELLS", 16)
    monkeypatch.setattr(trees, "FLUSH", 50)
    monkeypatch.setattr(trees, "LONG", 4000)
    monkeypatch.setattr(trees, "PIECE", 64)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                               "text string, lang string, source string, term string, n long, value long")
    got = [tuple(r) for r in trees.audit(df, min_docs=6, top_terms=7).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows, 6, 7)


def test_audit_of_no_rows(spark):
    assert trees.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_walk_prices_equal_node_pairs_once():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 3, (6, 256)) * (rng.random((6, 256)) < 0.1)
    counts[:, 200:] = -1
    leaves, levels, roots = trees.consed(counts)
    assert len(levels[0][0]) < 6 * 128 / 10                       # equal subtrees are one node
    totals = counts.clip(0).sum(1)
    a, b = np.array([0, 1, 2, 3]), np.array([4, 5, 5, 2])
    got = trees.walk(leaves, levels, roots, totals, 200, a, b)
    p = [[1 + 10 ** 9 * (int(c) + 5) // (int(t) + 1000) for c in row[:200]] for row, t in zip(counts, totals)]
    assert got.tolist() == [sum(abs(u - v) for u, v in zip(p[i], p[j])) for i, j in zip(a, b)]


def test_prices_are_exact_for_large_counts():
    counts = np.array([0, 1, 9 * 10 ** 14, 123456789012345])
    total = 10 ** 15 + 7
    assert trees.prices(counts, total, 1000).tolist() == [
        1 + 10 ** 9 * (int(c) + 5) // (total + 5000) for c in counts]
