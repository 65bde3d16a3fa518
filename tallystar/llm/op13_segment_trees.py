"""Source divergence audit over hash-consed segment trees.

Every group of documents (language, source) and every language has a term
distribution; the audit tells how far a source is from each other source of
its language, and which terms it uses more than its language does.

Terms are dealt to blocks of neighbouring ids, by falling frequency in the
language. In a block each group is a segment tree over the term ids. Trees
are hash-consed level by level: a leaf is a count, an inner node a pair of
child nodes, and equal count subtrees of all groups are one node (sources
share the long stretches of rare terms they never use). A pair of groups is
priced by walking both trees at once; the walk keeps one entry for each
distinct pair of nodes, so equal pairs are priced once wherever they stand.
A leaf pair costs |p - q| of its two counts, an inner pair the sum of its
children.

Shape of the job: one pass over the texts counts terms in each task (flushed
at ``FLUSH`` entries), a map-side combined sum, one join of the counts with
the kept terms, one task call for each (language, block). A block has at most
``CELLS`` counts in all groups together, whatever the number of sources, so
no key gathers an unbounded group. Its top terms and pair values are partial
results that Spark adds up and ranks.

All arithmetic is exact (64-bit whole numbers; the division is carried out in
steps of 1000, so counts up to 9e15 are safe).

Null text, language and source count as ''; a text without terms adds its
group only; repeated rows count each; an empty table gives no rows; equal
values rank by the bytes of the item; extra columns are ignored, whatever
their names. A text over ``LONG`` bytes is counted in several passes over
parts of the vocabulary, so memory does not grow with its length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystar.llm.hashing import ALNUM, class_table
from tallystar.session import cut_lineage
from tallystar.sources.testdata import read_table

SCALE_STEPS, STEP = 3, 1000            # p is scaled by STEP ** SCALE_STEPS
SMOOTH = 5
MIN_DOCS = 30
TOP_TERMS = 50
LEAVES = 1 << 12                       # most terms of a block
CELLS = 1 << 22                        # most counts of a block, all groups together
PAIR_CELLS = 1 << 21                   # leaf pairs held at once in a walk
FLUSH = 400_000                        # counted entries a task holds
LONG = 1 << 24                         # bytes of a text counted in one pass
PIECE = 1 << 20

LETTERS = ALNUM & ~class_table((0x30, 0x39))


# --- counting ---------------------------------------------------------------

def _pieces(text: bytes):
    """The text in pieces of about PIECE bytes that end outside a term."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and LETTERS[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _count_terms(batches):
    find = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+").findall
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows():
        names = ("lang", "source", "term", "n", "docs")
        out = {name: [] for name in names}
        for (lang, source), (n, docs) in held.items():
            size = len(n) + 1
            out["lang"] += [lang] * size
            out["source"] += [source] * size
            out["term"] += [None, *(t.decode("utf-8", "surrogatepass") for t in n)]
            out["n"] += [0, *n.values()]
            out["docs"] += [0, *(docs[t] for t in n)]
        held.clear()
        return pd.DataFrame(out)

    entries = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            group = held.get((lang, source))
            if group is None:
                group = held[lang, source] = Counter(), Counter()
                entries += 1
            n, docs = group
            data = text.encode("utf-8", "surrogatepass").lower()      # bytes: only A-Z change
            passes = 1 + len(data) // LONG
            for turn in range(passes):
                own: set[bytes] = set()
                before = len(n)
                for piece in _pieces(data):
                    terms = find(piece)
                    if passes > 1:
                        terms = [t for t in terms if zlib.crc32(t) % passes == turn]
                    n.update(terms)
                    own.update(terms)
                docs.update(own)
                entries += len(n) - before
                if entries >= FLUSH:
                    yield rows()
                    n, docs = held[lang, source] = Counter(), Counter()
                    entries = 1
    if held:
        yield rows()


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term
    in each group; one row with a null term stands for every group."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                          for c, name in ((lang, "lang"), (source, "source"), (text, "text"))))
    return (named.mapInPandas(_count_terms, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


# --- trees ------------------------------------------------------------------

def prices(counts: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)); 0 for padding (count -1)."""
    size = np.asarray(total, dtype=np.int64) + SMOOTH * terms
    p, rest = np.divmod(counts + SMOOTH, size)
    for _ in range(SCALE_STEPS):
        more, rest = np.divmod(rest * STEP, size)
        p = p * STEP + more
    return np.where(counts < 0, 0, p + 1)


def consed(counts: np.ndarray):
    """Hash-consed trees of the rows of ``counts`` (a power of two columns):
    (distinct leaf counts, [(left, right) children by level], root of each row)."""
    leaves, ids = np.unique(counts, return_inverse=True)
    ids = ids.reshape(counts.shape)
    levels, known = [], len(leaves)
    while ids.shape[1] > 1:
        node, ids2 = np.unique(ids[:, 0::2] * known + ids[:, 1::2], return_inverse=True)
        levels.append(np.divmod(node, known))
        ids, known = ids2.reshape(len(ids), -1), len(node)
    return leaves, levels, ids[:, 0]


def walk(leaves, levels, roots, totals, terms, a, b) -> np.ndarray:
    """Summed leaf costs of the tree pairs (a[k], b[k]), by one simultaneous
    walk from the roots down that keeps each distinct (pair, node, node) once."""
    who, x, y = np.arange(len(a)), roots[a], roots[b]
    merged = []
    for left, right in reversed(levels):
        wide = np.concatenate((who, who))
        x2, y2 = np.concatenate((left[x], right[x])), np.concatenate((left[y], right[y]))
        known = int(max(x2.max(), y2.max())) + 1
        code, back = np.unique((wide * known + x2) * known + y2, return_inverse=True)
        merged.append((len(who), back))
        rest, y = np.divmod(code, known)
        who, x = np.divmod(rest, known)
    value = np.abs(prices(leaves[x], totals[a[who]], terms) - prices(leaves[y], totals[b[who]], terms))
    for size, back in reversed(merged):
        value = value[back[:size]] + value[back[size:]]
    return value


def _price_block(entries: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Pair values and the top terms of one block of term ids."""
    groups = groups.sort_values("source", ignore_index=True)
    names = groups["source"].to_numpy(dtype=object)
    totals = groups["total"].to_numpy(dtype=np.int64)
    size, top = int(groups["size"].iloc[0]), int(groups["top"].iloc[0])
    terms, lang_total = int(groups["terms"].iloc[0]), int(groups["lang_total"].iloc[0])
    s = len(groups)
    width = 1 << max(0, size - 1).bit_length()
    counts = np.zeros((s, width), dtype=np.int64)
    counts[:, size:] = -1
    row = np.searchsorted(names, entries["source"].to_numpy(dtype=object)) if len(entries) else np.zeros(0, int)
    slot, n = entries["slot"].to_numpy(dtype=np.int64), entries["n"].to_numpy(dtype=np.int64)
    counts[row, slot] = n
    out = []
    if size:
        leaves, levels, roots = consed(counts)
    known = max([len(leaves), *(len(left) for left, _ in levels)]) if size else 1
    chunk = max(1, min(PAIR_CELLS // width, (1 << 62) // known ** 2))
    first = np.repeat(np.arange(s), np.arange(s - 1, -1, -1)) if s * s <= CELLS else None
    for a, b in _pairs(s, chunk, first):
        value = walk(leaves, levels, roots, totals, terms, a, b) if size else np.zeros(len(a), dtype=np.int64)
        out.append(pd.DataFrame({"part": "pair", "source": names[a], "item": names[b], "value": value}))
    if len(entries):
        p = prices(n, totals[row], terms)
        q = prices(entries["lang_n"].to_numpy(dtype=np.int64), lang_total, terms)
        more = pd.DataFrame({"part": "term", "source": entries["source"], "item": entries["term"], "value": p - q})
        more = more[more["value"] > 0]
        more = more.assign(key=more["item"].map(lambda t: t.encode("utf-8", "surrogatepass")))
        more = more.sort_values(["source", "value", "key"], ascending=[True, False, True])
        out.append(more.groupby("source").head(top).drop(columns="key"))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
        {"part": [], "source": [], "item": [], "value": []})


def _pairs(s: int, chunk: int, first: np.ndarray | None):
    """All a < b below s, in chunks."""
    if first is not None:
        start = np.concatenate(([0], np.cumsum(np.arange(s - 1, -1, -1))))[:s]
        second = np.arange(len(first)) - start[first] + first + 1
        for at in range(0, len(first), chunk):
            yield first[at:at + chunk], second[at:at + chunk]
        return
    for a in range(s):
        others = np.arange(a + 1, s)
        for at in range(0, len(others), chunk):
            b = others[at:at + chunk]
            yield np.full(len(b), a), b


# --- the audit ----------------------------------------------------------------

def _numbered(leaves: int):
    """Block and slot of each term; rows come by language and falling frequency."""
    def run(batches):
        block, lang, slot = TaskContext.get().partitionId() << 32, None, 0
        for batch in batches:
            blocks, slots = [], []
            for here in batch["lang"]:
                if here != lang or slot == leaves:
                    block, lang, slot = block + 1, here, 0
                blocks.append(block)
                slots.append(slot)
                slot += 1
            yield batch.assign(block=np.array(blocks, dtype=np.int64), slot=np.array(slots, dtype=np.int64))
    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank of every group."""
    counts = cut_lineage(term_counts(docs, text, lang, source))
    sources = counts.where("term is null").select("lang", "source")
    most = sources.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    leaves = max(1, min(LEAVES, CELLS // most))
    kept = (counts.where("term is not null").groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
            .where(F.col("lang_docs") >= min_docs).drop("lang_docs"))
    kept = cut_lineage(
        kept.repartitionByRange("lang", F.desc("lang_n"), "term").sortWithinPartitions("lang", F.desc("lang_n"), "term")
        .mapInPandas(_numbered(leaves), "lang string, term string, lang_n long, block long, slot long"))
    entries = cut_lineage(counts.where("term is not null").select("lang", "source", "term", "n")
                          .join(kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = (sources.join(entries.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"]))
    # One block without terms for each language: its pairs exist even if no term is kept.
    blocks = (kept.groupBy("lang", "block").agg(F.count("*").alias("size"))
              .unionByName(sources.select("lang").distinct()
                           .select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("size"))))
    right = groups.join(blocks, "lang").withColumn("top", F.lit(top_terms))

    def price(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = _price_block(left, right).assign(lang=key[0])
        return out.astype({name: object for name in ("lang", "part", "source", "item")})

    parts = cut_lineage(
        entries.groupBy("lang", "block").cogroup(right.groupBy("lang", "block"))
        .applyInPandas(price, "lang string, part string, source string, item string, value long"))
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct(F.col("source").alias("a"), F.col("item").alias("b")),
                             F.struct(F.col("item").alias("a"), F.col("source").alias("b"))))
    pairs = (pairs.select("lang", ends.alias("e"), "value")
             .select("lang", F.col("e.a").alias("source"), F.lit("pair").alias("part"), F.col("e.b").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = parts.where("part = 'term'").select("lang", "source", "part", "item", "value")
    return (pairs.withColumn("rank", F.row_number().over(order))
            .unionByName(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
lt AS (SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
gt AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + {SMOOTH})) // (coalesce(gt.n, 0) + {SMOOTH} * lt.v) AS p,
             1 + (1000000000::HUGEINT * (k.lang_n + {SMOOTH})) // (lt.n + {SMOOTH} * lt.v) AS q
      FROM grp g JOIN kept k USING (lang) JOIN lt USING (lang)
      LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
