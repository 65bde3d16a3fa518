"""Operators 1, 2, 4 and 5 against brute force and on edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallystar.llm import hashing, op01_automaton, op02_mcd, op04_rendezvous, op05_lineblock

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra=""):
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def write(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def norm(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_leaks(text, items):
    w = norm(text)
    hit, names = set(), set()
    for name, item in items:
        q = norm(item)
        if not q:
            continue
        size = min(10, len(q))
        grams = {tuple(q[i:i + size]) for i in range(len(q) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in grams:
                hit |= set(range(i, i + size))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


def test_words_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("ab é" [rng.randrange(4)] * rng.randrange(1, 9) for _ in range(rng.randrange(60)))
             for _ in range(40)] + ["", "x" * 500]
    whole = hashing.words(hashing.utf8(texts), hashing.NOT_BLANK, hashing.byte_codes(True))
    monkeypatch.setattr(hashing, "PIECE_BYTES", 37)
    cut = hashing.words(hashing.utf8(texts), hashing.NOT_BLANK, hashing.byte_codes(True))
    for a, b in zip(whole, cut):
        assert np.array_equal(a, b)
    assert [sum(whole[1] == k) for k in range(len(texts))] == [len(t.encode().split()) for t in texts]


def test_leaks_equal_brute_force(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in op01_automaton.query(spark, sf_dir).collect()}
    assert any(r.contaminated for r in got.values())
    for r in d:
        n, hit, names = brute_leaks(r.text, items)
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (n, hit, len(names), hit > 0)
        assert g.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()


@pytest.mark.parametrize("block", [100_000, 60])
def test_leaks_random_small_alphabet(spark, monkeypatch, block):
    rng = random.Random(5)
    monkeypatch.setattr(op01_automaton, "BLOCK_WORDS", block)
    monkeypatch.setattr(op01_automaton, "SEGMENT_WORDS", 25)
    pick = lambda n: " ".join(rng.choice(["a", "b", "c", "É"]) for _ in range(n))
    items = [(1, pick(30)), (2, pick(3)), (3, pick(9)), (4, pick(10)), (5, ""), (6, None), (None, pick(12)),
             (1, pick(11)), (7, pick(60))]
    texts = [pick(rng.randrange(0, 80)) for _ in range(60)] + [None, "", items[8][1], items[3][1] + " zzz", "a", "a"]
    got = op01_automaton.find_leaks(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    for r in got.collect():
        n, hit, names = brute_leaks(texts[r.doc_id], [("" if k is None else k, t) for k, t in items])
        assert (r.leak.n_words, r.leak.n_hit, list(r.leak["items"])) == (n, hit, names)


def test_decontaminate_removes_spans_and_drops_covered(spark):
    item = "one two three four five six seven eight nine ten eleven"
    filler = " ".join(f"w{i}" for i in range(40))
    texts = [f"{filler}, ONE two three four five six seven eight nine ten eleven! {filler}", item, filler, None, ""]
    out = {r.doc_id: r.text for r in op01_automaton.decontaminate(
        docs(spark, texts), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert out == {0: f"{filler}, ! {filler}", 2: filler, 3: None, 4: ""}
    none = op01_automaton.decontaminate(docs(spark, texts), spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == 5


def brute_stats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_mcd_statistics_and_edge_cases(spark, sf_dir):
    texts = ["", None, "a b c a b c a b c", "x\n\nx\n \ny\n y", "é ü #*<> |", "w " * 300] * 2
    rows = [(k, t, None if k % 3 else "de", None, 0, "clash") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC + ", __s string")
    out = op02_mcd.judge(df)
    for r in out.collect():
        n, chars, sym, dup, rep = brute_stats(texts[r.doc_id])
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == (n, chars, sym, dup, rep)
        assert q.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert q.kept is not None and not (q.base_failed and q.kept)
    assert op02_mcd.judge(df.limit(0)).count() == 0
    for r in op02_mcd.query(spark, sf_dir).collect()[:5]:
        assert r.n_words >= 0


def test_mcd_estimate_ignores_outliers(spark):
    """15 % far-off rows barely move centre and distances of the rest."""
    rng = np.random.default_rng(1)
    p = op02_mcd.P
    good = rng.normal(0, 1, (1700, p))
    bad = rng.normal(8, 0.3, (300, p))
    rows = [("g", "l", *map(float, x)) for x in np.vstack([good, bad])]
    df = spark.createDataFrame(rows, "g2 string, g1 string, " + ", ".join(f"x{i} double" for i in range(p)))
    model = {r.grp: r for r in op02_mcd.estimate(df).collect()}
    m = model["2g"]
    assert max(abs(m[f"m{i}"]) for i in range(p)) < 0.25
    w = np.array([[m[f"w{i}_{j}"] if j <= i else 0.0 for j in range(p)] for i in range(p)])
    centre = np.array([m[f"m{i}"] for i in range(p)])
    d = (((np.vstack([good, bad]) - centre) @ w.T) ** 2).sum(axis=1) / m["scale"]
    limit = op02_mcd.wilson_hilferty(p, op02_mcd.CUTOFF_Z)
    assert (d[:1700] > limit).sum() == 0 and (d[1700:] > limit).all()


def test_rendezvous_law(spark, tmp_path):
    texts = ["a"] * 5 + ["é", None, ""] + [f"t{i}" for i in range(800)]
    rows = [(None if k == 3 else min(k, 700), t, "en", "s", 0) for k, t in enumerate(texts)]
    sf = write(spark, tmp_path, documents=spark.createDataFrame(rows, DOC))
    out = op04_rendezvous.query(spark, sf).collect()
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    for s in range(8):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 8) for r in out)
    by_key = {}
    for r in out:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
    counts = Counter(s for s, _ in by_key.values())
    assert min(counts.values()) > 50


def test_rendezvous_weights(spark):
    df = spark.range(20000).selectExpr("id as doc_id", "'x' as text")
    out = op04_rendezvous.assign(df, "doc_id", "text", [1.0, 3.0])
    share = out.where("shard = 1").count() / 20000
    assert abs(share - 0.75) < 0.015
    assert op04_rendezvous.assign(df.limit(0), "doc_id", "text", [1.0]).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy now, a long line of advert text.</div>
<article><h1>Title &amp; more</h1><p><b>First   line<br><p>Second &lt;b&gt; line<p>Hm.</p><div class="comments"><p>Nice!</p></div>
<ul><li>one<li>two</ul><table><tr><td>x<td>y</table><p>By.</p></article><footer>&copy; me</footer>"""


def test_line_blocks():
    assert op05_lineblock.main_text(PAGE) == "\n".join(
        ["Title & more", "First line", "Second <b> line", "Hm.", "one", "two", "x", "y", "By."])
    assert op05_lineblock.main_text(None) == op05_lineblock.main_text("") == op05_lineblock.main_text("<p>") == ""
    plain = "<div>Home</div><div>About</div><div>a</div><div>b</div><p>" + "word " * 30 + "</p><p>" + "more " * 30 \
        + "</p><div>x</div><div>y</div><div>z</div><div>k</div>"
    got = op05_lineblock.main_text(plain).split("\n")
    assert "Home" not in got and "k" not in got and len([x for x in got if len(x) > 50]) == 2
    assert op05_lineblock.main_text("<script>x<p>hidden") == ""
    assert op05_lineblock.main_text("<a title='x > y'>ok</a> &#233;") == "ok é"
    op05_lineblock.main_text("<" * 20000)
    op05_lineblock.main_text("<p " + "a='" * 20000)


def test_class_words_do_not_drop_the_text():
    long = "<p>" + "A sentence of the article goes on. " * 6 + "</p>"
    for name in ("page has-sidebar", "container no-sidebar", "sidebar", "content-wrapper widget"):
        text = op05_lineblock.main_text(f'<div class="{name}"><article><h1>Title</h1>{long}</article></div>')
        assert text.startswith("Title\nA sentence"), name
        assert "A sentence" in op05_lineblock.main_text(f'<div class="{name}">{long}{long}</div><div>x</div>'), name
    for outer in ("article", "main", "div"):
        text = op05_lineblock.main_text(f'<{outer}><div class="entry-header"><h1>Title</h1></div>{long}'
                                        f'<div class="legal-analysis">{long}</div><div class="share">Share this.</div></{outer}>')
        assert text.startswith("Title\n") and text.count("\n") == 2 and "Share" not in text, outer
    assert "A sentence" in op05_lineblock.main_text(f'<form id="aspnetForm">{long}</form>')
    assert op05_lineblock.main_text(f'<article>{long}<p>A <span class="ad">buy</span>line</p></article>').endswith("\nA line")
    cards = '<div class="widget"><article><p>one</p></article></div>' * 3
    assert op05_lineblock.main_text(cards) == "one\none\none"
    side = f'<main>{long}</main><div class="related"><article><p>Teaser</p></article></div>'
    assert "Teaser" not in op05_lineblock.main_text(side)


def test_line_blocks_decide_on_unmarked_pages():
    para = lambda w: f"<p>{(w + ' ') * 30}end.</p>"
    link = lambda n: "".join(f"<div><a href='/{i}'>A rather long link title, number {i}</a></div>" for i in range(n))
    page = (f"<body><div>Home</div><div>About us</div><div>Contact</div>{link(9)}<h1>Title</h1>{para('first')}<p>Yes!</p>{para('second')}"
            f"{link(8)}{para('third')}<div>Tags</div><div>News</div><div>Log in</div>{link(7)}<p>Some small print here, made by us</p></body>")
    got = op05_lineblock.main_text(page).split("\n")
    assert [x.split()[0] for x in got] == ["Title", "first", "Yes!", "second", "third"]
    # Short lines that together hold 24 characters make no surge beside a text.
    menu = "<div>Products</div><div>Services</div><div>Customers</div>" * 4
    assert op05_lineblock.main_text(menu + para("word") + menu) == "word " * 30 + "end."
    assert op05_lineblock.main_text("<p>short</p><p>page</p>") == "short\npage"
    deep = "<div class='ad'>x" * 3000
    assert op05_lineblock.main_text(deep).startswith("x")


def test_line_blocks_on_pages(spark, sf_dir):
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    import html
    for r in op05_lineblock.query(spark, sf_dir).collect():
        body = re.search(r"<article>(.*)</article>", raw[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)
