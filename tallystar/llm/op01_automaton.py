"""Benchmark decontamination with a generalised suffix automaton.

The test items are normalised to words; a suffix automaton of all items
(grouped in blocks of bounded size) accepts every run of consecutive item
words. Training texts are streamed through it: after each word the automaton
holds the longest suffix of the text read so far that occurs in some item.
A match of at least ``max_match`` words (or a whole shorter item) makes the
matched words hits and names the items that contain them.

Scale: items are cut into overlapping segments of at most ``SEGMENT_WORDS``
words and dealt over blocks of about ``BLOCK_WORDS`` words; one automaton is
built per block in a task, and one block at a time is broadcast (its size is
bounded by BLOCK_WORDS). The texts pass once per block; no shuffle of texts.

Words: A-Z lower-cased, runs of 0-9, a-z and non-ASCII characters. Null and
empty texts have no words. Items without words match nothing; a null item id
counts as the empty id; equal ids count once; repeated documents each get
their own row; extra columns pass through untouched.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.batches import bound_batches, release
from tallystar.llm.hashing import ALNUM, byte_codes, text_runs, utf8, words
from tallystar.llm.names import free_name
from tallystar.session import cut_lineage
from tallystar.sources.testdata import read_table

MAX_MATCH = 10            # words in a window that counts as a leak
SEGMENT_WORDS = 20_000    # longest run of one item in one block
BLOCK_WORDS = 100_000     # item words per automaton
MAX_COVERAGE = 0.5        # documents with a larger share of hit words go
SHIFT = 32                # transitions are keyed by (state << SHIFT) | word number

SEGMENTS = "item string, whole int, n long, word_hashes binary"
LEAK = ("n_words long, n_hit long, longest int, starts array<int>, ends array<int>, "
        "items array<string>")


def item_segments(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Items as word hashes, long ones as segments overlapping by window - 1."""

    def run(batches):
        codes = byte_codes(lower=True)
        for pdf in batches:
            h, which, _, _ = words(utf8(pdf["text"]), ALNUM, codes)
            cut = np.searchsorted(which, np.arange(len(pdf) + 1))
            rows = []
            for k, name in enumerate(pdf["item"]):
                own = h[cut[k]:cut[k + 1]]
                for at in range(0, max(len(own) - window + 1, min(len(own), 1)), SEGMENT_WORDS - window + 1):
                    part = own[at:at + SEGMENT_WORDS]
                    rows.append((name, int(len(own) < window), len(part), part.tobytes()))
            yield pd.DataFrame(rows, columns=["item", "whole", "n", "word_hashes"])

    return (items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                         F.col(text).alias("text"))
            .mapInPandas(run, SEGMENTS))


def build_automaton(segments: list[tuple[str, int, np.ndarray]], window: int) -> dict:
    """Generalised suffix automaton of word sequences.

    step: transitions; link, size: suffix link and longest length per state;
    holder[state]: the state of the last ``window`` words, items[state]: the
    items with an occurrence ending there; short[state]: (words, items) of
    whole short items that are suffixes of the state's strings.
    """
    vocabulary = np.unique(np.concatenate([s[2] for s in segments]))
    step: dict[int, int] = {}
    out: list[list[int]] = [[]]          # words leaving each state, to copy a clone
    link, size = [-1], [0]

    def state(length: int) -> int:
        link.append(-1)
        size.append(length)
        out.append([])
        return len(size) - 1

    def put(p: int, w: int, q: int) -> None:
        key = p << SHIFT | w
        if key not in step:
            out[p].append(w)
        step[key] = q

    def clone_for(p: int, w: int, q: int) -> int:
        copy = state(size[p] + 1)
        for x in out[q]:
            put(copy, x, step[q << SHIFT | x])
        link[copy] = link[q]
        link[q] = copy
        while p >= 0 and step.get(p << SHIFT | w) == q:
            step[p << SHIFT | w] = copy
            p = link[p]
        return copy

    numbered = [(name, whole, np.searchsorted(vocabulary, h).tolist()) for name, whole, h in segments]
    for _, _, seq in numbered:
        last = 0
        for w in seq:
            q = step.get(last << SHIFT | w)
            if q is not None:
                last = q if size[q] == size[last] + 1 else clone_for(last, w, q)
                continue
            new, p = state(size[last] + 1), last
            while p >= 0 and p << SHIFT | w not in step:
                put(p, w, new)
                p = link[p]
            if p < 0:
                link[new] = 0
            else:
                q = step[p << SHIFT | w]
                link[new] = q if size[q] == size[p] + 1 else clone_for(p, w, q)
            last = new

    # The state that holds the suffix of ``window`` words, for states that long.
    holder = [-1] * len(size)
    for v in sorted(range(len(size)), key=size.__getitem__):
        if size[v] >= window:
            holder[v] = v if size[link[v]] < window else holder[link[v]]
    items: dict[int, set[str]] = {}
    ends: dict[int, dict[int, set[str]]] = {}
    for name, whole, seq in numbered:
        v = 0
        for w in seq:
            v = step[v << SHIFT | w]
            if holder[v] >= 0:
                items.setdefault(holder[v], set()).add(name)
        if whole:
            ends.setdefault(v, {}).setdefault(len(seq), set()).add(name)
    short: dict[int, dict[int, set[str]]] = {}
    if ends:
        for v in sorted(range(1, len(size)), key=size.__getitem__):
            above, own = short.get(link[v]), ends.get(v)
            if own:
                short[v] = {**(above or {}), **own}
            elif above:
                short[v] = above
    whole_sizes = [len(seq) for _, whole, seq in numbered if whole]
    return {"vocabulary": vocabulary, "step": step, "link": link, "size": size, "holder": holder,
            "items": {k: sorted(x) for k, x in items.items()},
            "short": {k: {n: sorted(x) for n, x in s.items()} for k, s in short.items()},
            "window": window, "least": min([window, *whole_sizes])}


def stream(automaton: dict, numbers: list[int], base: int, spans: list, found: set) -> int:
    """Walk one run of known words; add hit spans and item names, return the
    longest match."""
    step, link, size = automaton["step"], automaton["link"], automaton["size"]
    holder, short, window = automaton["holder"], automaton["short"], automaton["window"]
    items = automaton["items"]
    v = length = longest = 0
    for i, w in enumerate(numbers, base + 1):
        q = step.get(v << SHIFT | w)
        while q is None and v:
            v = link[v]
            length = size[v]
            q = step.get(v << SHIFT | w)
        if q is None:
            continue
        v = q
        length += 1
        if length > longest:
            longest = length
        reach = 0
        if length >= window:
            reach = window
            found.update(items[holder[v]])
        if short and v in short:
            for n, names in short[v].items():
                if n <= length:
                    reach = max(reach, n)
                    found.update(names)
        if reach:
            if spans and spans[-1][1] >= i - reach:
                spans[-1][0] = min(spans[-1][0], i - reach)
                spans[-1][1] = i
            else:
                spans.append([i - reach, i])
    return longest


def merged(spans: list) -> list:
    out: list = []
    for s, e in sorted(spans):
        if out and out[-1][1] >= s:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _matched(automaton: dict | None, raw: list[bytes], before: pd.DataFrame) -> pd.DataFrame:
    """Findings of a run of texts: those of earlier blocks with this block's added."""
    h, which, _, _ = words(raw, ALNUM, byte_codes(lower=True))
    cut = np.searchsorted(which, np.arange(len(raw) + 1))
    spans = [[[s, e] for s, e in zip(a, b)] for a, b in zip(before["starts"], before["ends"])]
    found = [set(x) for x in before["items"]]
    longest = np.array(before["longest"], dtype=np.int64)
    if automaton is not None and len(h):
        vocabulary = automaton["vocabulary"]
        number = np.searchsorted(vocabulary, h)
        number[number == len(vocabulary)] = 0
        known = vocabulary[number] == h
        run_edge = np.ones(len(h) + 1, dtype=bool)
        run_edge[1:-1] = (which[1:] != which[:-1]) | (known[1:] != known[:-1])
        edge = np.flatnonzero(run_edge)
        keep = known[edge[:-1]] & (np.diff(edge) >= automaton["least"])
        for a, b in zip(edge[:-1][keep].tolist(), edge[1:][keep].tolist()):
            k = int(which[a])
            own: list = []
            got = stream(automaton, number[a:b].tolist(), a - int(cut[k]), own, found[k])
            longest[k] = max(longest[k], got)
            spans[k].extend(own)
    spans = [merged(x) if len(x) > 1 else x for x in spans]
    return pd.DataFrame({
        "n_words": np.diff(cut), "n_hit": [sum(e - s for s, e in x) for x in spans],
        "longest": longest, "starts": [[s for s, _ in x] for x in spans],
        "ends": [[e for _, e in x] for x in spans], "items": [sorted(x) for x in found]})


def _matcher(blob):
    """Pandas UDF: text and earlier findings -> findings with this block's added.
    A batch is matched in runs of bounded size. Marked nondeterministic only so
    that Spark does not copy it into filters on its result and run it twice."""

    def run(text: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        automaton = pickle.loads(blob.value) if blob is not None else None
        raw = utf8(text)
        parts = [_matched(automaton, raw[a:b], before.iloc[a:b]) for a, b in text_runs(raw, 1 << 20)]
        release()
        return pd.concat(parts, ignore_index=True) if parts else _matched(None, [], before)

    return F.pandas_udf(run, LEAK).asNondeterministic()


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", max_match: int = MAX_MATCH, column: str = "leak") -> DataFrame:
    """``docs`` with a struct column: n_words, n_hit, longest match, hit word
    spans (starts, ends) and the names of the items found. A column of that
    name is replaced; others pass through whatever their names."""
    spark = docs.sparkSession
    bound_batches(spark)
    segments = cut_lineage(item_segments(items, item_id, item_text, max_match))
    total = segments.agg(F.sum("n").alias("n")).first()["n"] or 0
    n_blocks = -(-total // BLOCK_WORDS)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [(a, b, np.frombuffer(c, np.uint64))
                 for a, b, c in zip(pdf["item"], pdf["whole"], pdf["word_hashes"]) if len(c)]
        blob = pickle.dumps(build_automaton(parts, max_match)) if parts else b""
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "automaton": [blob]})

    out = docs.withColumn(column, F.struct(
        F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.lit(0).alias("longest"), F.array().cast("array<int>").alias("starts"),
        F.array().cast("array<int>").alias("ends"), F.array().cast("array<string>").alias("items")))
    if not n_blocks:
        return out.withColumn(column, _matcher(None)(F.col(text), F.col(column)))
    automata = cut_lineage(
        segments.withColumn("block", F.pmod(F.xxhash64("item", "word_hashes"), F.lit(n_blocks)).cast("int"))
        .groupBy("block").applyInPandas(build, "block int, automaton binary"))
    for block in range(n_blocks):          # one pass of the texts per block of items
        row = automata.where(F.col("block") == block).first()
        if row is None:
            continue
        out = out.withColumn(column, _matcher(spark.sparkContext.broadcast(bytes(row["automaton"])))(
            F.col(text), F.col(column)))
        if block + 1 < n_blocks:
            out = cut_lineage(out)
    return out


def _without(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    """The texts without the words of their spans (and what stands between them)."""
    out = []
    for t, a, b in zip(text, starts, ends):
        if t is None or not len(a):
            out.append(t)
            continue
        raw = utf8([t])[0]
        _, _, first, last = words([raw], ALNUM, byte_codes(lower=True))
        at, kept = 0, []
        for s, e in zip(a, b):
            kept.append(raw[at:int(first[s])])
            at = int(last[e - 1])
        kept.append(raw[at:])
        out.append(b"".join(kept).decode("utf-8", "surrogatepass"))
    return pd.Series(out)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", max_match: int = MAX_MATCH,
                  max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without leaked spans; documents whose hit words exceed
    ``max_coverage`` of all their words are left out. Same columns as ``docs``."""
    name = free_name(docs, "__leak")
    found = find_leaks(docs, items, text, item_id, item_text, max_match, name)
    cut = F.pandas_udf(_without, "string")
    hit = F.col(f"{name}.n_hit")
    kept = found.where(hit <= F.lit(max_coverage) * F.col(f"{name}.n_words"))
    return kept.withColumn(text, F.when(hit > 0, cut(F.col(text), F.col(f"{name}.starts"), F.col(f"{name}.ends")))
                           .otherwise(F.col(text))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("leak.n_words").alias("n_words"), F.col("leak.n_hit").alias("n_hit"),
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"), F.col("leak.longest").alias("longest_match"))
