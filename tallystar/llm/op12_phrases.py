"""Document fingerprints by locally consistent parsing.

A text is parsed in levels. Runs of one symbol become one symbol; then
deterministic coin tossing gives each symbol a label: twice the lowest bit
place in which its name differs from its left neighbour's, plus that bit. Four
rounds bring 64-bit names down to six labels, three more steps to three; no
two neighbours share a label, so local maxima are two to four symbols apart.
A phrase runs from one maximum to the next and gets a 64-bit name from the
names in it; the phrase names are the string of the next level, until one
name, the root, is left. Cuts depend on at most ``MARGIN`` symbols to either
side, so equal substrings have equal phrases inside, wherever they stand.

The fingerprint is the root and, for levels 1 to 3 (phrases of about 3, 9 and
25 bytes), a one-permutation min-hash sketch of the phrase names: ``BINS``
bins, 12 bits each; as text 592 hex digits, ``fff`` for an empty bin. The likeness of two fingerprints is 1 for equal roots;
else the share of phrases that the two have in common (Dice, from the
sketch's Jaccard estimate 2 J / (1 + J)), at the highest level at which both
fill ``ENOUGH`` bins, or at level 1.

``edits`` pairs each document with the next one in falling key order. The
texts are dealt once by key ranges; inside a partition rows stream in order,
and only the first and the last row of each partition, a number bounded by
the number of partitions, are matched by a second small join.

Null text is the empty text: root 0, no phrases, like 1 to another empty text
and 0 to any other. Null keys come last, rows of one key in the order of
their texts' hashes (repeated rows follow each other). One document alone is
its own next. An empty table gives no rows. A text over ``PIECE`` bytes is
parsed as a stream of pieces, with the same phrases and bounded memory. Extra
columns pass through ``fingerprints`` and are ignored by ``edits``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.hashing import BASE, byte_codes, mix64, text_runs, utf8
from tallystar.session import cut_lineage
from tallystar.sources.testdata import read_table

LEVELS, BINS = 3, 64
ENOUGH = 32
MARGIN = 16
PIECE = 1 << 19
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
NONE = 0xFFF                          # an empty bin
CODES = byte_codes()

# Place of the only set bit of a 64-bit word, by a de Bruijn product.
_BRUIJN = np.uint64(0x03F79D71B4CB0A89)
_PLACE = np.zeros(64, dtype=np.uint8)
_PLACE[[int((int(_BRUIJN) << k & 0xFFFFFFFFFFFFFFFF) >> 58) for k in range(64)]] = np.arange(64)


def _toss_table() -> np.ndarray:
    """The next label from (left label, own label), both below 128."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    other = left ^ own
    place = np.zeros_like(other)
    for k in range(6, -1, -1):
        place[(other >> k) & 1 == 1] = k
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()
_FREE = np.array([[min(c for c in (0, 1, 2) if c not in (a, b)) for b in range(7)] for a in range(7)], np.uint8)


def phrase_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a phrase starts; ``first`` marks the first name of each text.
    Neighbours inside a text must differ."""
    n = len(names)
    head = np.flatnonzero(first)
    left = np.empty_like(names)
    left[0], left[1:] = names[0], names[:-1]
    other = names ^ left
    place = _PLACE[((other & (~other + np.uint64(1))) * _BRUIJN) >> np.uint64(58)]
    place[head] = 0
    label = 2 * place + ((names >> place) & np.uint64(1)).astype(np.uint8)
    for _ in range(3):
        pair = np.zeros(n, dtype=np.uint16)
        pair[1:] = label[:-1]
        toss = _TOSS[pair * np.uint16(128) + label]
        toss[head] = label[head] & 1
        label = toss
    padded = np.empty(n + 2, dtype=np.uint8)
    for high in (5, 4, 3):
        at = np.flatnonzero(label == high)
        padded[1:-1] = label
        padded[0] = padded[-1] = 6
        before, after = padded[at], padded[at + 2]
        before[first[at]] = 6
        ends = at + 1 < n
        after[~ends] = 6
        after[ends] = np.where(first[at[ends] + 1], 6, after[ends])
        label[at] = _FREE[before, after]
    start = first.copy()
    if n > 2:
        top = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:] & ~first[1:-1]
        start[1:-1] |= top
    return start


def _named_runs(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.where(lengths > 1, mix64(symbols + lengths.astype(np.uint64) * BASE), symbols)


def _named_phrases(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sizes = np.diff(np.append(starts, len(names)))
    place = np.arange(len(names)) - np.repeat(starts, sizes)
    parts = mix64(names * BASE + place.astype(np.uint64))
    return mix64(np.add.reduceat(parts, starts) + sizes.astype(np.uint64))


def next_level(symbols: np.ndarray, first: np.ndarray):
    """Phrase names of the texts held in ``symbols``, and their first marks."""
    change = first.copy()
    change[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(change)
    names = _named_runs(symbols[at], np.diff(np.append(at, len(symbols))))
    own = first[at]
    starts = np.flatnonzero(phrase_starts(names, own))
    return _named_phrases(names, starts), own[starts]


class _Level:
    """One level of a text that comes in pieces: gives the same phrase names."""

    def __init__(self):
        self.open = None                        # last run: it may go on in the next piece
        self.held = np.zeros(0, np.uint64)      # names from the open phrase on, with context before
        self.start = 0                          # where the open phrase starts in held
        self.at_head = True
        self.count, self.single = 0, None

    def push(self, symbols: np.ndarray, last: bool = False) -> np.ndarray:
        if len(symbols):
            change = np.empty(len(symbols), dtype=bool)
            change[0] = True
            change[1:] = symbols[1:] != symbols[:-1]
            at = np.flatnonzero(change)
            lengths = np.diff(np.append(at, len(symbols)))
            symbols = symbols[at]
            if self.open is not None:
                if self.open[0] == symbols[0]:
                    lengths[0] += self.open[1]
                else:
                    symbols = np.concatenate((self.open[:1], symbols))
                    lengths = np.concatenate((self.open[1:].astype(np.int64), lengths))
            self.open = np.array([symbols[-1], lengths[-1]], dtype=np.uint64)
            symbols, lengths = symbols[:-1], lengths[:-1]
            self.held = np.concatenate((self.held, _named_runs(symbols, lengths)))
        if last and self.open is not None:
            self.held = np.concatenate((self.held, _named_runs(self.open[:1], self.open[1:].astype(np.int64))))
            self.open = None
        n = len(self.held)
        if not n:
            return self.held
        first = np.zeros(n, dtype=bool)
        first[0] = self.at_head
        cuts = np.flatnonzero(phrase_starts(self.held, first))
        cuts = cuts[(cuts > self.start) & (cuts < (n if last else n - MARGIN))]
        starts = np.concatenate(([self.start], cuts))
        if last:
            out = _named_phrases(self.held[self.start:], starts - self.start)
            self.held = self.held[:0]
        else:
            stop = starts[-1]
            out = (_named_phrases(self.held[self.start:stop], starts[:-1] - self.start)
                   if stop > self.start else self.held[:0])
            keep = max(0, stop - MARGIN)
            self.held, self.start = self.held[keep:], stop - keep
            self.at_head = self.at_head and keep == 0
        if len(out):
            self.count += len(out)
            self.single = out[0]
        return out


def _sketch(table: np.ndarray, text, names: np.ndarray) -> None:
    h = mix64(names ^ BASE)
    np.minimum.at(table, (text, (h & np.uint64(BINS - 1)).astype(np.int64)), h >> np.uint64(6))


def _long_print(data: bytes, tables: list[np.ndarray]) -> np.uint64:
    """Root and sketches (rows of one text) of a text parsed in pieces."""
    if len(data) == 1:
        return CODES[data[0]]
    levels = [_Level()]

    def feed(k: int, symbols: np.ndarray, last: bool) -> None:
        names = levels[k].push(symbols, last)
        if k < LEVELS and len(names):
            _sketch(tables[k], np.zeros(len(names), np.int64), names)
        if last and levels[k].count == 1:
            return
        if len(names) or last:
            if k + 1 == len(levels):
                levels.append(_Level())
            feed(k + 1, names, last)

    for at in range(0, len(data), PIECE):
        feed(0, CODES[np.frombuffer(data, np.uint8, min(PIECE, len(data) - at), at)], False)
    feed(0, np.zeros(0, np.uint64), True)
    return next(level.single for level in levels if level.count == 1)


def prints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(roots, sketches): one uint64 and LEVELS x BINS uint16 of each text;
    NONE marks an empty bin, root 0 an empty text."""
    roots = np.zeros(len(texts), dtype=np.uint64)
    sketches = np.full((len(texts), LEVELS, BINS), NONE, dtype=np.uint16)
    for low, high in text_runs(texts, PIECE):
        tables = [np.full((high - low, BINS), EMPTY) for _ in range(LEVELS)]
        short = [k for k in range(low, high) if 0 < len(texts[k]) <= PIECE]
        for k in range(low, high):
            if len(texts[k]) > PIECE:
                roots[k] = _long_print(texts[k], [t[k - low:k - low + 1] for t in tables])
        if short:
            sizes = np.array([len(texts[k]) for k in short])
            symbols = CODES[np.frombuffer(b"".join(texts[k] for k in short), np.uint8)]
            who = np.array(short)                                   # texts still in the string
            for level in range(64):
                single = sizes == 1
                begin = np.cumsum(sizes) - sizes
                if single.any():
                    roots[who[single]] = symbols[begin[single]]
                    symbols = symbols[np.repeat(~single, sizes)]
                    who, sizes = who[~single], sizes[~single]
                    begin = np.cumsum(sizes) - sizes
                if not len(who):
                    break
                first = np.zeros(len(symbols), dtype=bool)
                first[begin] = True
                symbols, first = next_level(symbols, first)
                begin = np.flatnonzero(first)
                sizes = np.diff(np.append(begin, len(symbols)))
                if level < LEVELS:
                    _sketch(tables[level], np.repeat(who - low, sizes), symbols)
        for level, table in enumerate(tables):
            part = sketches[low:high, level]
            np.copyto(part, np.minimum(table & np.uint64(NONE), np.uint64(NONE - 1)).astype(np.uint16), where=table != EMPTY)
    return roots, sketches


def packed(roots: np.ndarray, sketches: np.ndarray) -> list[bytes]:
    """Fingerprints as bytes: the root, then two bins in three bytes."""
    bins = sketches.reshape(len(roots), -1, 2)
    a, b = bins[..., 0], bins[..., 1]
    body = np.stack((a >> 4, (a & 15) << 4 | b >> 8, b & 255), axis=-1).astype(np.uint8).reshape(len(roots), -1)
    return [int(r).to_bytes(8, "big") + row.tobytes() for r, row in zip(roots, body)]


def as_strings(roots: np.ndarray, sketches: np.ndarray) -> list[str]:
    return [p.hex() for p in packed(roots, sketches)]


def from_strings(values) -> tuple[np.ndarray, np.ndarray]:
    """The arrays behind fingerprint strings."""
    data = np.frombuffer(b"".join(bytes.fromhex(v) for v in values), np.uint8).reshape(len(values), -1)
    roots = np.ascontiguousarray(data[:, :8]).view(">u8").astype(np.uint64).ravel()
    triples = data[:, 8:].reshape(len(values), -1, 3).astype(np.uint16)
    pairs = np.stack((triples[..., 0] << 4 | triples[..., 1] >> 4, (triples[..., 1] & 15) << 8 | triples[..., 2]), axis=-1)
    return roots, pairs.reshape(len(values), LEVELS, BINS)


def likenesses(a, b) -> np.ndarray:
    """Likeness of the fingerprints a[k] and b[k], as (roots, sketches)."""
    full_a, full_b = a[1] != NONE, b[1] != NONE
    same = ((a[1] == b[1]) & full_a).sum(2)
    either = (full_a | full_b).sum(2)
    jaccard = same / np.maximum(either, 1)
    filled = np.minimum(full_a.sum(2), full_b.sum(2)) >= ENOUGH
    level = np.where(filled.any(1), LEVELS - 1 - filled[:, ::-1].argmax(1), 0)
    j = jaccard[np.arange(len(level)), level]
    return np.where(a[0] == b[0], 1.0, 2 * j / (1 + j))


# --- DataFrame operators ------------------------------------------------------

def fingerprints(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text (a column of that name is replaced)."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(as_strings(*prints(utf8(texts))), dtype=object)

    return docs.withColumn(column, F.pandas_udf(run, "string")(F.col(text)))


def likeness(a, b):
    """Column: likeness (0 to 1) of two fingerprint columns; null if either is."""
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        known = (left.notna() & right.notna()).to_numpy()
        out = np.full(len(left), np.nan)
        if known.any():
            out[known] = likenesses(from_strings(left[known]), from_strings(right[known]))
        return pd.Series(out)

    value = F.pandas_udf(run, "double")(F.col(a), F.col(b))
    return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), value)


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the first as many code points of
    ``following`` (all of them if it has fewer)."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


_RESULT = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double")


HEX = ("edited_sha256", "fingerprint", "edited_fingerprint")


def _results(texts: list[str], mine, after: list[str], theirs) -> dict:
    changed = [edited(t, n).encode("utf-8", "surrogatepass") for t, n in zip(texts, after)]
    other = prints(changed)
    return {"n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(c).digest() for c in changed],
            "fingerprint": packed(*mine), "edited_fingerprint": packed(*other),
            "near_edited": likenesses(mine, other), "near_next": likenesses(mine, theirs)}


def _runs_of(texts: list[str], limit: int = 1 << 21):
    at = held = 0
    for k, t in enumerate(texts):
        held += len(t) + 1
        if held >= limit:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _stream(batches):
    """Rows of one key range in falling key order: a result for each row that
    has its next one here, the texts of the first and of the last row."""
    part, last = TaskContext.get().partitionId(), None
    for batch in batches:
        keys, texts = batch["key"].to_list(), batch["text"].to_list()
        for low, high in _runs_of(texts):
            key, text = keys[low:high], texts[low:high]
            mine = prints(utf8(text))
            if last is None:
                yield pd.DataFrame({"kind": ["head"], "part": [part], "key": [key[0]], "text": [text[0]]})
            else:
                key, text = [last[0], *key], [last[1], *text]
                mine = tuple(np.concatenate(x) for x in zip(last[2], mine))
            last = key[-1], text[-1], tuple(x[-1:] for x in mine)
            if len(key) > 1:
                found = _results(text[:-1], tuple(x[:-1] for x in mine), text[1:], tuple(x[1:] for x in mine))
                yield pd.DataFrame({"kind": "row", "part": part, "key": key[:-1], "text": None, **found})
    if last is not None:
        yield pd.DataFrame({"kind": ["tail"], "part": [part], "key": [last[0]], "text": [last[1]]})


def _matched(batches):
    for batch in batches:
        text, after = batch["text"].to_list(), batch["after"].to_list()
        for low, high in _runs_of([t + n for t, n in zip(text, after)]):
            mine, theirs = prints(utf8(text[low:high])), prints(utf8(after[low:high]))
            yield pd.DataFrame({"key": batch["key"].to_list()[low:high],
                                **_results(text[low:high], mine, after[low:high], theirs)})


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how near they are
    to each other and to the next document (falling ``key``)."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The row number only spreads repeated rows over ranges; it never decides between different rows.
    order = [F.col("key").desc_nulls_last(), F.xxhash64("text"), F.col("row")]
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    schema = f"kind string, part long, key {kind}, text string, {_RESULT}"
    fields = [tuple(f.split()) for f in schema.split(", ")]
    names = [f[0] for f in fields]

    def stream(batches):
        for out in _stream(batches):
            yield out.reindex(columns=names).astype({name: object for name, kind in fields if kind in ("string", "binary")})

    done = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
                       .mapInPandas(stream, schema))
    ends = done.where("kind <> 'row'")
    parts = sorted(r.part for r in ends.where("kind = 'head'").select("part").collect())   # one number a partition
    follows = docs.sparkSession.createDataFrame(
        [(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part long, next_part long")
    heads = ends.where("kind = 'head'").select(F.col("part").alias("next_part"), F.col("text").alias("after"))
    tails = (ends.where("kind = 'tail'").select("part", "key", "text").join(follows, "part").join(heads, "next_part")
             .select("key", "text", "after").mapInPandas(_matched, f"key {kind}, {_RESULT}"))
    names = ["key", *names[4:]]
    both = done.where("kind = 'row'").select(*names).unionByName(tails.select(*names))
    return both.select(F.col("key").alias(key), *(F.lower(F.hex(f)).alias(f) if f in HEX else F.col(f) for f in names[1:]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(read_table(spark, sf_dir, "documents"))
