"""Operator 2 against a NumPy estimate, its plan, and clashing names."""

import random
import re

import numpy as np
import pytest

from tallystar.llm import op02_mcd

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(2, 10))) for _ in range(600)]
    rows = []
    for k in range(900):
        n = rng.randrange(60, 400)
        own = [rng.choice(words) for _ in range(n)]
        own = [w.capitalize() if rng.random() < .04 else w for w in own]
        lines = [" ".join(own[i:i + 12]) for i in range(0, n, 12)]
        if k % 15 == 0:
            kind = (k // 15) % 3
            if kind == 0:
                lines = [x.upper() for x in lines]
            elif kind == 1:
                lines = [re.sub("[aeiou]", "#", x) for x in lines]
            else:
                lines = ["x" * 60 + " " + x.replace(" ", "zzzzzzzzzz ") for x in lines]
        rows.append((k, "\n".join(lines), ("en", "de")[k % 3 == 0], f"s{k % 2}", 0))
    return rows


def numpy_mcd(x):
    """Smallest determinant of the concentrated subsets of the three starts."""
    n, p = x.shape
    ridge = np.diag(op02_mcd.RIDGE)
    q = np.quantile(x, [.25, .5, .75], axis=0)
    best = None
    for mean, cov in ((q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2)), (q[1], np.eye(p)), (x.mean(0), np.cov(x.T, bias=True))):
        for _ in range(100):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov + ridge), x - mean)
            near = x[np.argsort(d, kind="stable")[:int(np.ceil(op02_mcd.SUPPORT * n))]]
            mean, cov = near.mean(0), np.cov(near.T, bias=True)
        det = np.linalg.slogdet(cov + ridge)[1]
        if best is None or det < best[0] - 1e-3:
            best = det, mean, cov + ridge
    _, mean, cov = best
    d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    scale = max(np.median(d) / op02_mcd.wilson_hilferty(p, 0.0), 1.0)
    return mean, cov, scale


def test_verdict_equals_a_numpy_estimate(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], DOC + ", s string, grp string, x0 string, __m string")
    out = op02_mcd.judge(df)
    assert out.columns == [*df.columns, "quality"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) and all((r.s, r.grp, r.x0, r["__m"]) == ("a", "b", "c", "d") for r in got.values())
    groups, x = {}, {}
    for k, _, lang, source, _ in rows:
        q = got[k].quality
        if q.base_failed:
            continue
        n, chars, lines = max(q.n_words, 1), max(q.word_chars, 1), max(q.n_lines, 1)
        x[k] = [np.log(n), np.log(chars / n), np.sqrt(q.n_symbols / chars), np.sqrt(q.n_dup_lines / lines),
                np.sqrt(q.n_repeat_words / n), np.sqrt(q.n_upper / chars)]
        for level in ((lang, source), (lang,), ()):
            groups.setdefault(level, []).append(k)
    models = {g: numpy_mcd(np.array([x[k] for k in own])) for g, own in groups.items()
              if len(own) >= op02_mcd.MIN_GROUP or g == ()}
    assert len(models) >= 4
    limit = op02_mcd.wilson_hilferty(op02_mcd.P, op02_mcd.CUTOFF_Z)
    for k, _, lang, source, _ in rows:
        if k not in x:
            continue
        mean, cov, scale = next(models[g] for g in ((lang, source), (lang,), ()) if g in models)
        d = np.array(x[k]) - mean
        want = float(d @ np.linalg.inv(cov) @ d) / scale
        assert got[k].quality.distance == pytest.approx(want, rel=0.1, abs=0.2)
        if abs(want - limit) > 0.1 * limit:
            assert got[k].quality.kept == (want <= limit)
    bad = [k for k in x if k % 15 == 0]
    assert sum(got[k].quality.kept for k in bad) <= 0.1 * len(bad)
    assert sum(got[k].quality.kept for k in x if k % 15) >= 0.99 * sum(1 for k in x if k % 15)


def test_rows_of_a_group_are_spread(spark, monkeypatch):
    """Without broadcasts rows meet models by group and salt, never by group alone."""
    plans = []
    real = op02_mcd.cut_lineage
    monkeypatch.setattr(op02_mcd, "cut_lineage",
                        lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(corpus()[:300], DOC)
        op02_mcd.judge(df).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    steps = [p for p in plans if "FlatMapGroupsInPandas" in p and "bin" in p]
    assert steps
    for plan in steps:
        lines = plan.splitlines()
        for k, line in enumerate(lines):
            found = re.search(r"Exchange hashpartitioning\(([^)]*?), \d+\)", line)
            if found and re.fullmatch(r"grp#\d+", found[1]):
                assert "HashAggregate" in lines[k + 1] or "partial" in lines[k + 1], line


NAMES = ["leak", "__leak", "__row", "__found", "__extra", "__t", "__c", "__base", "__more", "__pii", "row", "s", "key", "grp"]


@pytest.mark.parametrize("apply", ["decontaminate", "prefix_ranks", "gear_chunks", "redact", "leaks"])
def test_clashing_columns_pass_through(spark, apply):
    from tallystar.llm import op01_automaton, op03_prefix_ranks, op06_gear_chunks, op08_weak_pii
    item = "one two three four five six seven eight nine ten eleven"
    long = "".join(chr(97 + k * 7 % 26) for k in range(400))
    texts = ["clean text here", f"before {item} after " + "word " * 40, None, "", f"mail a.b@example.org now {long}", f"x{long}"]
    df = spark.createDataFrame([(k, t, "en", "s", 0, *[f"{n}{k}" for n in NAMES]) for k, t in enumerate(texts)],
                               DOC + ", " + ", ".join(f"{n} string" for n in NAMES))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    run = {"decontaminate": lambda: op01_automaton.decontaminate(df, items),
           "leaks": lambda: op01_automaton.find_leaks(df, items, column="found"),
           "prefix_ranks": lambda: op03_prefix_ranks.deduplicate(df),
           "gear_chunks": lambda: op06_gear_chunks.deduplicate(df), "redact": lambda: op08_weak_pii.redact(df)}[apply]
    out = run()
    assert out.columns[:len(df.columns)] == df.columns
    rows = out.collect()
    assert len(rows) == len(texts)
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
    assert run().limit(0).count() == 0


def test_line_blocks_weigh_markers():
    from tallystar.llm.op05_lineblock import main_text
    long = "<p>" + "A sentence of the article goes on and on. " * 8 + "</p>"
    body = main_text(f'<article><h1>Title</h1></article><div class="content">{long}{long}</div><div>x</div>')
    assert body.startswith("Title\nA sentence") and body.count("A sentence") == 16
    teaser = f"<article><h1>Main</h1>{long}{long}</article><p>Read also</p><article><p>A teaser of another text.</p></article>"
    assert main_text(teaser).startswith("Main\n") and "teaser" not in main_text(teaser) and "Read also" not in main_text(teaser)
    for name in ("user-comments", "comments", "comment-list", "reader_comments", "disqus_thread", "replies"):
        for outer in ("article", "div"):
            page = f'<{outer}><h1>T</h1>{long}<div class="{name}">{long.replace("sentence", "remark")}</div></{outer}>'
            assert "remark" not in main_text(page) and main_text(page).count("A sentence") == 8, name
    assert "A sentence" in main_text(f'<div class="has-comments">{long}</div>')
    assert main_text(f'<article>{long}<p style="Display : none">gone</p><p hidden>gone</p></article>').count("gone") == 0
    assert "word" not in main_text(f"<article>{long}{long}</article><p>{'word ' * 60}</p>")


def test_segments_equal_a_loop():
    from tallystar.llm.op05_lineblock import segments
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([0, 0, 5, 20, 50, 90]) for _ in range(rng.randrange(1, 40))]
        inside = [False] * len(sizes)
        for k in range(len(sizes)):
            if sum(sizes[k:k + 3]) >= 80:
                for j in range(k, min(k + 3, len(sizes))):
                    inside[j] = True
        want, first = [], None
        for k, flag in enumerate([*inside, False]):
            if flag and first is None:
                first = k
            elif not flag and first is not None:
                want.append((first, k))
                first = None
        assert segments(np.array(sizes), 3, 80) == want


def test_unmarked_pages_give_their_article(spark, sf_dir):
    """Markers removed: the distribution finds nearly the same text."""
    from tallystar.llm.op05_lineblock import main_text
    same = total = extra = 0
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        want = main_text(r.html)
        bare = re.sub(r"</?article>", "", r.html).replace('class="ad"', "").replace("<nav>", "<div>").replace("</nav>", "</div>")
        got = main_text(bare)
        total += len(want)
        same += sum(len(x) + 1 for x in want.split("\n") if x in set(got.split("\n")))
        extra += sum(len(x) + 1 for x in got.split("\n") if x not in set(want.split("\n")))
    assert same >= 0.97 * total and extra <= 0.1 * total


@pytest.mark.parametrize("piece", ["<div>x", "</p>", "<select>", "<textarea>x<p>", "<a '", "<a \"<b '", "<", "<!--x", "<div class='ad'>y",
                                   "<p style='", "&amp;<i>", "<article>z"])
def test_hostile_pages_are_linear(piece):
    import time

    from tallystar.llm.op05_lineblock import main_text
    page = piece * (2_000_000 // len(piece))
    start = time.process_time()
    main_text(page)
    main_text("<article><p>" + page)
    assert time.process_time() - start < 30
