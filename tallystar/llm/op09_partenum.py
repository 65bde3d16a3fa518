"""N-gram Jaccard join with PartEnum signatures.

A document is its set of distinct 5-word shingles. Two sets of Jaccard
similarity >= 0.75 differ in at most a third of the smaller one's size, k.
PartEnum turns that into equal signatures: per size band the shingle domain
is partitioned into groups of ``N2`` parts; as k differences cannot put two
or more of them into every one of k // 2 + 1 groups, some group differs in at
most ``K2`` = 1 part, and the sets share one of the enumerated signatures of
``N2 - K2`` parts. Sets take signatures for their own band and the next, so
any two similar sets meet in one band. Groups are taken in a fixed order, the
ones of shingles counted in many documents last: that order only saves work,
any order gives the same links. Small sets (up to ``SINGLES``) use single
shingles as parts: as many of the first in that order as a similar set can
lack, and one more.

Signatures are packed into one binary value per bucket and batch (about 5
bytes each), so the shuffle holds no row per signature. A bucket (about
``BUCKET_ENTRIES`` signatures, a range of hashes) gives candidate pairs: each
member of a signature with its smallest member. Each set is verified against
the smallest of its partners first; links join into components, and of the
other pairs only those across components are verified then, so a group of near
copies costs about one pair for each member. Verification is on the full
shingle sets, after exact bounds from sizes and parity sketches. Signatures that still hold several components then have
their members compared across components by the same bounds, inside tasks and
in blocks. Of the pairs that pass, each member's ``CLOSEST`` few are verified
first, which joins most of a group; then all that are still across components
are. So no link between different sets is lost, members already joined are not
paired again, and the pairs of a group are never rows of a table.

Equal sets (64-bit sum of shingle hashes) are one set throughout, so copies
are never paired. A group needs at least two filled parts to count; a set
short of such groups takes all it has and signs by single shingles as well: a
similar set that is not short meets it in one of its own groups, one that is
short by a shingle. Null and empty texts have empty sets, linked with
nothing; repeated rows have equal sets; an empty table gives no rows; extra
columns pass through whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tallystar.llm.batches import bound_batches, release, tidy
from tallystar.llm.components import components
from tallystar.llm.hashing import BASE, NOT_BLANK, byte_codes, chains, mix64, utf8, words
from tallystar.llm.names import free_name
from tallystar.session import cut_lineage, few_files
from tallystar.sources.testdata import read_table

SHINGLE = 5
PERCENT = 75                # linked when 100 * intersection >= PERCENT * union
N2, K2 = 3, 1
SINGLES = 224               # largest set with single shingles as parts
GROUP_FILL = 1.75           # shingles per group at the low end of a band (3.5 at the top)
BUCKET_ENTRIES = 1_000_000
SLAB = 1 << 21              # shingles counted at a time to find the frequent ones
PAIRS_PER_TASK = 10_000     # pairs whose texts a task lays side by side
SETS_PER_TASK = 50_000      # sets with sketches in one file
SLAB_DOCUMENTS = 8_000      # documents a counting task has at least
MAX_SKETCH_BITS = 1 << 16
SMALL = 32                  # members of a signature paired by a join
FIRST = 16                  # signatures a member brings to a comparison
BLOCK = 1024                # members of a signature compared at once
CLOSEST = 4                 # nearest members of other components verified first
COMPARED = 1 << 20          # words of sketches laid against each other at once
PAIRS_OUT = 1 << 17         # pairs of a comparing task's output batch
FREQUENT = 4                # documents, and
FREQUENT_SHARE = 1 / 2000   # share of them, that make a shingle frequent
SIG_MASK = np.uint64((1 << 32) - 1)


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    h, which, _, _ = words(texts, NOT_BLANK, byte_codes(lower=True))
    cut = np.searchsorted(which, np.arange(len(texts) + 1))
    full = chains(h, n)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= n:
            one = np.sort(full[a:b - n + 1])
            new = np.ones(len(one), bool)
            np.not_equal(one[1:], one[:-1], out=new[1:])
            out.append(one[new])
        else:
            out.append(chains(h[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def _lengths(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Size of each set and where it begins in their concatenation."""
    size = np.array([len(s) for s in sets], np.int64)
    return size, np.cumsum(size) - size


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """Signed 64-bit ids of sets."""
    size, begin = _lengths(sets)
    total, full = np.zeros(len(sets), np.uint64), size > 0
    if full.any():
        total[full] = np.add.reduceat(mix64(np.concatenate(sets) + np.uint64(1)), begin[full])
    return mix64(total + size.astype(np.uint64)).view(np.int64)


def bands(size: int) -> list[int]:
    """Group counts (0: singles) of the bands a set of this size signs for: its
    own and that of its largest partner."""
    def groups(s: float) -> int:
        return 0 if s <= SINGLES else 1 << int(np.ceil(np.log2(s / (2 * GROUP_FILL))))
    return sorted({groups(size), groups(size * 100 // PERCENT)})


def signatures(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """PartEnum signatures of one set of shingles."""
    return all_signatures([s], frequent)[0]


def all_signatures(sets: list[np.ndarray], frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of sets of shingles, and the set (its number) of each."""
    size, _ = _lengths(sets)
    flat, own = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    k = size * (100 - PERCENT) // PERCENT      # most differences to any similar set
    alone = size * (100 - PERCENT) // 100 + 1  # single shingles, one more than a similar set can lack
    rank = np.searchsorted(frequent, flat) if len(frequent) else np.zeros(len(flat), np.int64)
    often = frequent[np.minimum(rank, len(frequent) - 1)] == flat if len(frequent) else np.zeros(len(flat), bool)
    content_of = mix64(flat + np.uint64(5))
    by_band: dict[int, list[int]] = {}
    for i, n in enumerate(size.tolist()):
        for groups in bands(n) if n else ():
            by_band.setdefault(groups, []).append(i)
    single = np.zeros(len(sets), bool)
    single[by_band.pop(0, [])] = True
    out, out_own = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for groups, members in by_band.items():
        chosen = np.zeros(len(sets), bool)
        chosen[members] = True
        at = np.flatnonzero(chosen[own])
        spot = mix64(flat[at] + np.uint64(groups * int(BASE) & (1 << 64) - 1))
        part = (spot % np.uint64(groups * N2)).astype(np.int64)
        part = np.where(often[at], groups * N2 + rank[at], part)      # frequent shingles: later groups
        most = groups + len(frequent) // N2 + 1                       # groups of a set
        place = own[at] * (most * N2) + part
        order = np.argsort(place)
        place = place[order]
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        content = np.add.reduceat(content_of[at][order], first)
        place = place[first]
        start = np.flatnonzero(np.concatenate(([True], place[1:] // N2 != place[:-1] // N2)))
        filled = np.diff(np.append(start, len(place)))
        holder, group = np.divmod(place[start] // N2, most)
        good = np.cumsum(filled >= N2 - K2)
        # Groups of a set are taken until it has enough good ones.
        head = np.flatnonzero(np.concatenate(([True], holder[1:] != holder[:-1])))
        before = np.append(0, good)[head]                              # good groups of the sets before
        need = k[holder[head]] // (K2 + 1) + 1
        single[holder[head]] |= good[np.append(head[1:], len(good)) - 1] - before < need     # short of groups
        per_set = np.diff(np.append(head, len(holder)))
        taken = np.append(0, good)[:-1] - np.repeat(before, per_set) < np.repeat(need, per_set)
        table = np.zeros((len(start), N2), np.uint64)
        table[np.repeat(np.arange(len(start)), filled), place % N2] = content
        table, name, holder = table[taken], group[taken].astype(np.uint64), holder[taken]
        for a in range(N2):
            for b in range(a + 1, N2):
                any_ = (table[:, a] != 0) | (table[:, b] != 0)
                x = mix64(table[:, a] * BASE + np.uint64(a * N2 + b + 1)) + table[:, b]
                out.append(mix64(mix64(x) + (name * np.uint64(64) + np.uint64(a * N2 + b)) * BASE
                                 + np.uint64(groups))[any_])
                out_own.append(holder[any_])
    if single.any():
        at = np.flatnonzero(single[own])
        at = at[np.argsort(own[at] * 2 + often[at], kind="stable")]
        lone = np.flatnonzero(single & (size > 0))
        nth = np.arange(len(at)) - np.repeat(np.cumsum(size[lone]) - size[lone], size[lone])
        at = at[nth < alone[own[at]]]
        out.append(mix64(flat[at] + np.uint64(77)))
        out_own.append(own[at])
    return np.concatenate(out), np.concatenate(out_own)


def _sliced(pdf: pd.DataFrame, column: str, limit: int = 1 << 21):
    """Row ranges of about ``limit`` bytes of text."""
    raw = utf8(pdf[column])
    at = held = 0
    for i, t in enumerate(raw):
        held += len(t)
        if held >= limit or i + 1 == len(raw):
            yield at, raw[at:i + 1]
            at, held = i + 1, 0


def _pack(sets: np.ndarray, sigs: np.ndarray, owner: np.ndarray, n_buckets: int):
    """(bucket, blob) rows: sets, entries per set, the signatures' low 32 bits
    (the bucket comes from the high ones). In a bucket of BUCKET_ENTRIES about
    100 pairs meet by chance; verification drops them."""
    bucket = (sigs >> np.uint64(32)) % np.uint64(n_buckets)
    order = np.argsort(bucket.astype(np.int64) * len(sets) + owner)
    bucket, owner, sigs = bucket[order], owner[order], sigs[order] & SIG_MASK
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)]):
        own = owner[a:b]
        head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        counts = np.diff(np.append(head, b - a)).astype(np.uint32)
        yield int(bucket[a]), np.uint32(len(head)).tobytes() + sets[own[head]].tobytes() + counts.tobytes() \
            + sigs[a:b].astype(np.uint32).tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    sets = np.frombuffer(blob, np.int64, n, 4)
    counts = np.frombuffer(blob, np.uint32, n, 4 + 8 * n)
    m = int(counts.sum())
    return np.repeat(sets, counts), np.frombuffer(blob, np.uint32, m, 4 + 12 * n)


def _meet(blobs) -> pd.DataFrame:
    """One bucket: pairs (group 0) of each set with the smallest set of a shared
    signature, and members of groups of three or more (group: membership hash)."""
    parts = [_unpack(b) for b in blobs]
    sets, sigs = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(sigs, kind="stable")
    sigs = sigs[order]
    again = np.zeros(len(sigs), bool)
    same = sigs[1:] == sigs[:-1]
    again[1:] |= same
    again[:-1] |= same
    sigs, sets = sigs[again], sets[order][again]
    order = np.lexsort((sets, sigs))
    sigs, sets = sigs[order], sets[order]
    keep = np.concatenate(([True], (sigs[1:] != sigs[:-1]) | (sets[1:] != sets[:-1]))) if len(sigs) else np.zeros(0, bool)
    sigs, sets = sigs[keep], sets[keep]
    empty = pd.DataFrame({"grp": np.zeros(0, np.int64), "a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    if not len(sigs):
        return empty
    first = np.flatnonzero(np.concatenate(([True], sigs[1:] != sigs[:-1])))
    count = np.diff(np.append(first, len(sigs)))
    hub = np.repeat(sets[first], count)
    pair = sets != hub
    pairs = np.unique(np.stack([sets[pair], hub[pair]], axis=1), axis=0) if pair.any() else np.zeros((0, 2), np.int64)
    members = np.add.reduceat(mix64(sets.view(np.uint64) + np.uint64(9)), first)
    group = np.flatnonzero(count > 2)
    _, one = np.unique(members[group], return_index=True)
    group = group[one]
    take = np.concatenate([np.arange(first[g], first[g] + count[g]) for g in group]) if len(group) else np.zeros(0, np.int64)
    name = np.repeat(members[group].view(np.int64) | 1, count[group]) if len(group) else np.zeros(0, np.int64)
    return pd.DataFrame({"grp": np.concatenate((np.zeros(len(pairs), np.int64), name)),
                         "a": np.concatenate((pairs[:, 0], sets[take])),
                         "b": np.concatenate((pairs[:, 1], sets[take]))})


def sketch(s: np.ndarray) -> bytes:
    """Parities of the set's shingles over a power of two of bits (at least
    twice the set's size, at most MAX_SKETCH_BITS). Two sets' sketches, folded
    to one width, differ in no more bits than the sets differ in shingles."""
    return sketches_of([s])[0]


def sketches_of(sets: list[np.ndarray]) -> list[bytes]:
    """``sketch`` of each set."""
    spots = (mix64(np.concatenate(sets) + np.uint64(31)) & np.uint64(MAX_SKETCH_BITS - 1)).astype(np.int64)
    out = []
    for n, at in zip(*(x.tolist() for x in _lengths(sets))):
        bits = min(MAX_SKETCH_BITS, max(64, 1 << (2 * n - 1).bit_length()))
        out.append(np.packbits(np.bincount(spots[at:at + n] & (bits - 1), minlength=bits) & 1).tobytes())
    return out


def sketch_distance(x: bytes, y: bytes) -> int:
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def _least(n: int) -> float:
    """Documents of ``n`` that make a shingle frequent."""
    return max(FREQUENT, n * FREQUENT_SHARE)


def counted_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Two kinds of rows from one reading of the texts. Of each document: key,
    row (hash of key and text), set id, number of shingles and sketch. And
    (h, c), with no set: shingles h found in c texts, of which ``frequent_of``
    makes the frequent ones. Texts equal within a slab count once. Each slab
    passes on the shingles of its own share of the documents that make a
    shingle frequent, so what it holds back adds up to less than that."""
    n = docs.count()
    least = _least(n)
    kinds = [StructField("key", docs.select(key).schema[0].dataType)] + [StructField(c, LongType()) for c in ("row", "set", "n")] \
        + [StructField("sketch", BinaryType())] + [StructField(c, LongType()) for c in "hc"]

    def fold(sets):
        share = max(1, int(np.ceil(least * len(sets) / n)))     # texts that a shingle needs to be passed on
        h = np.concatenate(sets)
        sets.clear()
        h.sort()
        h = h[:len(h) - share + 1][h[share - 1:] == h[:len(h) - share + 1]] if share <= len(h) else h[:0]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        c = np.diff(np.append(first, len(h))) + share - 1
        return h[first], c

    def run(batches):
        names = [f.name for f in kinds]
        key_kind = None

        def count_rows(sets):
            h, c = fold(sets)
            for a in range(0, len(h), SLAB // 16):
                m = len(h[a:a + SLAB // 16])
                none = [pa.nulls(m, key_kind), *[pa.nulls(m, pa.int64())] * 3, pa.nulls(m, pa.binary())]
                yield pa.RecordBatch.from_arrays([*none, pa.array(h[a:a + m].view(np.int64)), pa.array(c[a:a + m].astype(np.int64))], names)

        full, held, size, seen = [], [], 0, set()
        for batch in batches:
            key_kind = batch.column("key").type
            for at, raw in _sliced({"text": batch.column("text").to_pylist()}, "text"):
                sets, m = shingle_sets(raw), len(raw)
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").slice(at, m), batch.column("row").slice(at, m), pa.array(set_ids(sets)),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(sketches_of(sets), pa.binary()),
                    pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names)
                for t, s in zip(map(hash, raw), sets):
                    if t not in seen and len(s):
                        held.append(s)
                        size += len(s)
                    seen.add(t)
                if size >= SLAB:                          # kept until the next is full, so none is small
                    if full:
                        yield from count_rows(full)
                    full, held, size, seen = held, [], 0, set()
        if full or held:
            full += held
            held.clear()
            yield from count_rows(full)

    return (docs.select(F.col(key).alias("key"), _row(key, text), F.col(text).cast("binary").alias("text"))
            .coalesce(max(1, n // SLAB_DOCUMENTS)).mapInArrow(tidy(run), StructType(kinds)))


def set_rows(counted: DataFrame) -> DataFrame:
    """The rows of documents of ``counted_sets``."""
    return counted.where("set is not null").select("key", "row", "set", "n", "sketch")


def frequent_of(counted: DataFrame, n: int) -> np.ndarray:
    """Sorted shingles of many of ``n`` documents: every shingle of 2 * least
    documents is found, none of fewer than least. Only orders the parts."""
    often = (counted.where("set is null").groupBy("h").agg(F.sum("c").alias("c"))
             .where(F.col("c") >= _least(n)).select("h"))
    rows = often.collect()          # at most the shingles of all sets / least: as many for any number of documents
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def frequent_shingles(docs: DataFrame, text: str) -> np.ndarray:
    """``frequent_of`` the texts, counted over all of them."""
    return frequent_of(counted_sets(docs, text, text), docs.count())


def with_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, row (hash of key and text), set id, number of shingles and sketch
    per document."""
    return set_rows(counted_sets(docs, key, text))


def distinct_sets(sets: DataFrame) -> DataFrame:
    """set, n, sketch and the smallest row of each set of ``with_sets``."""
    return sets.groupBy("set").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("row").alias("row"))


def _row(key: str, text: str) -> F.Column:
    return F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row")


def candidate_groups(docs: DataFrame, text: str, often: np.ndarray, shingles: int) -> DataFrame:
    """(grp, a, b): grp 0 are candidate pairs of set ids, others the members a
    of signatures of three or more sets. ``often``: the frequent shingles,
    ``shingles``: of all sets together, about as many as signatures."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(often)
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shingles // BUCKET_ENTRIES))

    def emit(batches):
        for batch in batches:
            for _, raw in _sliced({"text": batch.column("text").to_pylist()}, "text", 1 << 20):
                sets = [s for a in range(0, len(raw), 256) for s in shingle_sets(raw[a:a + 256]) if len(s)]
                if not sets:
                    continue
                ids, one = np.unique(set_ids(sets), return_index=True)
                sigs, owner = all_signatures([sets[i] for i in one.tolist()], frequent.value)
                rows = list(_pack(ids, sigs, owner, n_buckets))
                for a in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[a:a + 64]], pa.int32()),
                                                      pa.array([r[1] for r in rows[a:a + 64]], pa.binary())], ["bucket", "blob"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _meet(pdf["blob"])
        release()
        return out

    packed = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(tidy(emit), "bucket int, blob binary")
    return packed.groupBy("bucket").applyInPandas(meet, "grp long, a long, b long")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if not len(x) or not len(y):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int((y[at] == x).sum())
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out. Both bounds are
    exact: similar sets differ in at most (size a + size b) / 7 shingles."""
    side = lambda c: sets.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    joined = (pairs.join(side("a"), "a").join(side("b"), "b")
              .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT))

    def run(n_a: pd.Series, n_b: pd.Series, s_a: pd.Series, s_b: pd.Series) -> pd.Series:
        return pd.Series([(100 + PERCENT) * sketch_distance(x, y) <= (100 - PERCENT) * (n + m)
                          for n, m, x, y in zip(n_a, n_b, s_a, s_b)], dtype=bool)

    return joined.where(F.pandas_udf(run, "boolean")("n_a", "n_b", "s_a", "s_b")).select("a", "b")


def verify(pairs: DataFrame, docs: DataFrame, sets: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (a, b) of set ids whose full shingle sets are similar. ``sets``
    has a row per set (see ``distinct_sets``). Only texts that a remaining pair
    needs are gathered, one per set."""
    left = cut_lineage(few_files(possible(pairs, sets), pairs.count(), PAIRS_PER_TASK))
    n = left.count()
    needed = left.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    chosen = sets.join(needed, "set", "left_semi").select("set", "row")
    texts = cut_lineage(few_files(docs.select(_row(key, text), F.col(text).alias("text")).join(chosen, "row")
                                  .groupBy("set").agg(F.min("text").alias("text")), 2 * n, PAIRS_PER_TASK))
    side = lambda c: texts.select(F.col("set").alias(c), F.col("text").alias(f"t_{c}"))

    def run(t_a: pd.Series, t_b: pd.Series) -> pd.Series:
        out = []
        for i in range(0, len(t_a), 128):
            x, y = utf8(t_a[i:i + 128]), utf8(t_b[i:i + 128])
            texts = list(dict.fromkeys(x + y))
            sets = dict(zip(texts, shingle_sets(texts)))
            out += [similar(sets[p], sets[q]) for p, q in zip(x, y)]
        release()
        return pd.Series(out, dtype=bool)

    both = left.join(side("a"), "a").join(side("b"), "b")
    return cut_lineage(few_files(both.where(F.pandas_udf(run, "boolean")("t_a", "t_b")).select("a", "b"), n, PAIRS_PER_TASK))


def _compare(n, roots, sketches, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (of ``first`` x ``second``; each pair once, the smaller index
    first, where both are the same array) in different components that sizes
    and sketches do not rule out, and how far apart their sketches are. Half of
    a sketch's words rule out most pairs; the others are compared whole."""
    none = np.zeros(0, np.int64)
    out_a, out_b, out_d = [none], [none], [np.zeros(0)]
    once, width = first is second, sketches.shape[1]
    half = -(-width // 2)
    words_of = np.ascontiguousarray(sketches[second, :half].T)
    step = min(64, max(1, COMPARED // len(second)))
    for at in range(0, len(first), step):
        i, skip = first[at:at + step], at if once else 0
        j = second[skip:]
        total = n[i][:, None] + n[j][None, :]
        apart = np.zeros(total.shape, np.uint16)       # of half a sketch: at most MAX_SKETCH_BITS / 2
        for k in range(half):
            apart += np.bitwise_count(sketches[i, k][:, None] ^ words_of[k, skip:][None, :])
        ok = (apart <= (100 - PERCENT) * total // (100 + PERCENT)) & (roots[i][:, None] != roots[j][None, :])
        ok &= np.minimum(n[i][:, None], n[j][None, :]) * 100 >= np.maximum(n[i][:, None], n[j][None, :]) * PERCENT
        x, y = np.nonzero(ok)
        far, size = apart[x, y].astype(np.int64), total[x, y]
        x, y = i[x], j[y]
        if half < width:
            for a in range(0, len(x), piece := max(1, COMPARED // width)):
                far[a:a + piece] += np.bitwise_count(sketches[x[a:a + piece], half:] ^ sketches[y[a:a + piece], half:]).sum(axis=1, dtype=np.int64)
        ok = (100 + PERCENT) * far <= (100 - PERCENT) * size
        if once:
            ok &= x < y
        out_a.append(x[ok])
        out_b.append(y[ok])
        out_d.append(far[ok] / size[ok])
    return np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_d)


def _folded(raw: list[bytes]) -> np.ndarray:
    """Sketches as rows of words, folded to the shortest one's width."""
    width = min(map(len, raw))
    rows = []
    for x in raw:
        a = np.frombuffer(x, np.uint8)
        while len(a) > width:
            a = a[:len(a) // 2] ^ a[len(a) // 2:]
        rows.append(a)
    return np.stack(rows).view(np.uint64)


def _groups(batches, columns: list[str]):
    """Runs of rows of equal ``columns`` of sorted batches, as dicts of arrays;
    a run may go on in the next batch."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        change = np.zeros(len(pdf), bool)
        change[0] = bool(held) and any(held[-1][c].iloc[-1] != pdf[c].iloc[0] for c in columns)
        for c in columns:
            v = pdf[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change).tolist()
        if not cuts:
            held.append(pdf)
            continue
        if held or cuts[0]:
            whole = pd.concat([*held, pdf.iloc[:cuts[0]]]) if cuts[0] else pd.concat(held)
            yield {c: whole[c].to_numpy() for c in whole}
        arrays = {c: pdf[c].to_numpy() for c in pdf}
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield {c: v[a:b] for c, v in arrays.items()}
        held = [pdf.iloc[cuts[-1]:]]
    if held:
        whole = pd.concat(held)
        yield {c: whole[c].to_numpy() for c in whole}


def _closest(x: np.ndarray, y: np.ndarray, far: np.ndarray, few: int) -> np.ndarray:
    """Whether a pair is among the ``few`` nearest of either member."""
    keep = np.zeros(len(x), bool)
    for own, other in ((x, y), (y, x)):
        order = np.lexsort((other, far, own))
        sorted_ = own[order]
        keep[order[np.arange(len(order)) - np.searchsorted(sorted_, sorted_) < few]] = True
    return keep


def across(named: DataFrame, sets: DataFrame, few: int | None = None, wide_only: bool = False) -> DataFrame:
    """Pairs (a, b) of members of one signature (grp, set, root) in different
    components that sizes do not rule out. Up to SMALL members meet in a join;
    those of larger groups are compared by their sketches inside tasks, in
    blocks of about BLOCK, so a large group is spread and none of its pairs is
    a row before it has passed. With ``few``, a member of a larger group brings
    its ``few`` nearest there only; without, groups of up to SMALL, which such
    a call has paired, are left out if ``wide_only``. ``sets`` has a row per set."""
    split = named.groupBy("grp").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m")) \
        .where("lo != hi").where(F.col("m") > (SMALL if wide_only else 0)).select("grp", "m", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    open_ = cut_lineage(few_files(named.join(split, "grp"), named.count()))
    sized = open_.where(F.col("m") <= SMALL).join(sets.select("set", "n"), "set")
    left = sized.select("grp", F.col("set").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"))
    right = sized.select("grp", F.col("set").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"))
    small = (left.join(right, "grp").where("a > b and ra != rb")
             .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT).select("a", "b"))
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    wide = open_.where(F.col("m") > SMALL)
    # A pair that an earlier signature (by number) has too need not come again;
    # each member brings its first FIRST signatures to tell. The first shared
    # one always gives the pair.
    first = F.slice(F.array_sort(F.collect_set("grp")), 1, FIRST).alias("grps")
    one = sets.select("set", "n", "sketch").join(wide.groupBy("set").agg(first), "set")
    spread = (wide.join(one, "set").withColumn("own", own).withColumn("other", other)
              .withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other")))

    def pairs_of(rows: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sketches = _folded(rows["sketch"].tolist())
        n, ids, roots = rows["n"], rows["set"], rows["root"]
        mine = rows["own"] == rows["p"]
        first = np.flatnonzero(mine)
        second = first if mine.all() else np.flatnonzero(~mine)
        x, y, far = _compare(n, roots, sketches, first, second)
        if few:
            near = _closest(x, y, far, few)
            x, y, far = x[near], y[near], far[near]
            return np.maximum(ids[x], ids[y]), np.minimum(ids[x], ids[y]), far
        grp, held = int(rows["grp"][0]), {}
        for i in np.unique(np.concatenate((x, y))).tolist():
            before = rows["grps"][i]
            held[i] = set(before[:np.searchsorted(before, grp)].tolist())
        new = np.fromiter((held[i].isdisjoint(held[j]) for i, j in zip(x, y)), bool, len(x))
        x, y = x[new], y[new]
        return np.maximum(ids[x], ids[y]), np.minimum(ids[x], ids[y]), np.zeros(len(x))

    def run(batches):
        ready, size = [], 0
        for rows in _groups(batches, ["grp", "p", "q"]):
            found = pairs_of(rows)
            ready.append(found)
            size += len(found[0])
            if size >= PAIRS_OUT:
                yield pd.DataFrame(dict(zip(("a", "b", "far"), map(np.concatenate, zip(*ready)))))
                ready, size = [], 0
        if ready:
            yield pd.DataFrame(dict(zip(("a", "b", "far"), map(np.concatenate, zip(*ready)))))

    # The blocks of a task come one after the other: a call for each would cost
    # more than most comparisons.
    large = (spread.repartition("grp", "p", "q").sortWithinPartitions("grp", "p", "q")
             .mapInPandas(tidy(run), "a long, b long, far double"))
    if few:                                                        # the nearest of all its groups
        large = large.groupBy("a", "b").agg(F.min("far").alias("far"))
        sides = large.select("*", F.explode(F.array("a", "b")).alias("own"))
        rank = F.row_number().over(Window.partitionBy("own").orderBy("far", "a", "b"))
        large = sides.withColumn("rank", rank).where(F.col("rank") <= few)
    return small.unionByName(large.select("a", "b")).distinct()


def apart(pairs: DataFrame, root: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets in different components."""
    for side in "ab":
        pairs = pairs.join(root.select(F.col("node").alias(side), F.col("root").alias(f"r_{side}")), side, "left")
    return (pairs.where(F.coalesce("r_a", "a") != F.coalesce("r_b", "b")).select("a", "b"))


def _placed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, row, set, n and root (smallest set id reachable) of every document."""
    bound_batches(docs.sparkSession)
    counted = cut_lineage(counted_sets(docs, key, text))
    sets = set_rows(counted)
    total = sets.agg(F.count("*").alias("rows"), F.sum("n").alias("shingles")).first()
    one = cut_lineage(few_files(distinct_sets(sets), total["rows"], SETS_PER_TASK))
    found = cut_lineage(candidate_groups(docs, text, frequent_of(counted, total["rows"]), total["shingles"] or 0))
    n = found.count()
    pairs = cut_lineage(few_files(found.where("grp = 0").select("a", "b").distinct(), n))
    nearest = pairs.groupBy("a").agg(F.min("b").alias("b"))
    links = verify(nearest, docs, one, key, text)
    root = components(links)
    rest = cut_lineage(few_files(apart(pairs.join(nearest, ["a", "b"], "left_anti"), root), n))
    if rest.first() is not None:
        links = links.unionByName(verify(rest, docs, one, key, text))
        root = components(links)
    # Signatures that still hold several components: compare across them, the
    # nearest members first.
    members = cut_lineage(few_files(found.where("grp != 0").select("grp", F.col("a").alias("set")).distinct(), n))
    for few, wide_only in ((CLOSEST, False), (None, True)):
        if wide_only:
            wide = named.groupBy("grp").agg(F.count("*").alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi"))
            members = named.join(wide.where(F.col("m") > SMALL).where("lo != hi"), "grp", "left_semi").select("grp", "set")
        named = cut_lineage(few_files(members.join(root.withColumnRenamed("node", "set"), "set", "left")
                                      .withColumn("root", F.coalesce("root", "set")), n))
        more = cut_lineage(across(named, one, few, wide_only).join(pairs, ["a", "b"], "left_anti"))
        if more.first() is not None:
            linked = verify(more, docs, one, key, text)
            pairs = pairs.unionByName(more)
            if linked.first() is not None:
                links = links.unionByName(linked)
                root = components(links)
    return (sets.join(root.withColumnRenamed("node", "set"), "set", "left")
            .select("key", "row", "set", "n", F.coalesce("root", "set").alias("root")))


def link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, row, set, n (shingles) and component (smallest key reachable, null
    only if all are) of every document."""
    placed = _placed(docs, key, text)
    smallest = placed.where("n > 0").groupBy("root").agg(F.min("key").alias("least"))
    return (placed.join(smallest, "root", "left")
            .select("key", "row", "set", "n", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest
    key, null keys last (of repeated rows, one). Documents without words all
    stay. Components are sets of linked texts, so different texts that share a
    key, or have none, are not mistaken for each other."""
    placed = cut_lineage(_placed(docs, key, text))
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "row"))["row"]
    kept = placed.where("n > 0").groupBy("root").agg(first.alias("row")).select("row")
    rows = placed.where("n > 0").join(kept, "row", "left_semi").groupBy("row").agg(F.count("*").alias("copies"))
    row, copies = free_name(docs, "__row"), free_name(docs, "__copies")
    named = docs.withColumn(row, _row(key, text))
    blank = placed.where("n = 0").select("row").distinct().withColumn("copies", F.lit(1).cast("long"))
    stay = named.join(rows.unionByName(blank).withColumnsRenamed({"row": row, "copies": copies}), row)
    once = stay.where(F.col(copies) == 1).select(*docs.columns)
    again = stay.where(F.col(copies) > 1).dropDuplicates([row]).select(*docs.columns)
    return once.unionByName(again)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
