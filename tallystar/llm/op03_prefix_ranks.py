"""Exact substring deduplication by ranking byte positions at growing prefixes.

A byte goes if it lies in a ``LENGTH``-byte string (200) that also starts
anywhere else. Prefix doubling ranks every position by longer and longer
prefixes and drops a position once its rank is unique. Here the ranks are
64-bit names (equal bytes, equal name), and the rounds are

1. names of ``SEED``-byte prefixes at sampled positions. Each 200-byte string
   elects the smallest name inside it, so equal strings elect the same place;
   a run of neighbouring strings that elect one position shares one row.
   Runs whose name is unique drop out: nothing in them repeats.
2. names of all bytes a run covers. Runs with an equal partner are past the
   threshold: all their strings repeat. Unique ones go on.
3. for the runs left, names of every 200-byte prefix: the pair of the ranks of
   its two 100-byte halves, at positions p and p + 100. Repeated pairs mark
   their position.

Sorting all positions in every round would shuffle 16 bytes for each byte of
text eight times over; sampling changes which positions are ranked first, not
the result. Runs travel packed, about 25 bytes for 70 positions; equal runs
of one batch are combined before the shuffle, so copies cost one entry per
batch. Within a bucket (a range of names) ranking is a local sort.

Hot names (a line in many different texts) are found beforehand in one of
``SAMPLE`` texts; which names these are changes where entries are dealt, not
the result. Their runs are dealt by name and bytes, all different ones go on to
round 3, and there their strings are dealt by the string's own name: equal
strings meet, different ones spread. Equal strings of one batch are combined,
so a hot string costs one entry for each batch.

Matches never cross documents; strings are judged on the input. Null and
empty texts have no bytes; texts under 200 bytes keep all; repeated rows are
copies of each other. Names collide with probability below 1e-9 for 10**13
bytes. What is left after a cut may split a character: ``kept`` is binary.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.hashing import BASE, byte_codes, mix64, powers, prefix_hash, range_hash, utf8
from tallystar.llm.names import free_name
from tallystar.session import cut_lineage
from tallystar.sources.testdata import read_table

LENGTH = 200
SEED = 64
WINDOW = LENGTH - SEED + 1
PIECE = 1 << 20            # bytes per vectorised step; positions fit POSITION_BITS
POSITION_BITS = 22
BUCKET_BYTES = 20_000_000  # text bytes per bucket of names
SAMPLE = 64                # one of so many texts is searched for hot names
HOT = 64                   # runs of a hot name in the sample, at least
HOT_NAMES = 1_000_000      # hot names, at most: HOT grows with very large inputs


def _row(key: str, text: str) -> F.Column:
    return F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("row")


def _joined(rows, texts):
    """Blocks of (rows, first bytes in the block, offset in the text, sizes, data);
    a long text is cut into pieces that overlap by LENGTH - 1 bytes."""
    held, size = [], 0
    for row, raw in zip(rows, texts):
        if len(raw) < LENGTH:
            continue
        for at in range(0, len(raw) - LENGTH + 1, PIECE):
            part = raw[at:at + PIECE + LENGTH - 1]
            held.append((row, at, part))
            size += len(part)
            if size >= PIECE:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def _block(held):
    sizes = np.array([len(p[2]) for p in held], np.int64)
    return (np.array([p[0] for p in held], np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])),
            np.array([p[1] for p in held], np.int64), sizes, np.frombuffer(b"".join(p[2] for p in held), np.uint8))


def _sliding_min(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive entries."""
    n = len(key)
    full = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = key
    table = full.reshape(-1, w)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def runs_of(block):
    """Runs of strings that elect one position: (piece, start, strings, name,
    name of all their bytes)."""
    rows, first, offset, sizes, data = block
    prefix = prefix_hash(data, byte_codes())
    _, down = powers(len(data) + 1)
    n = len(data) - SEED + 1
    name = mix64((prefix[SEED:] - prefix[:n]) * down[:n] + np.uint64(SEED))
    low = np.uint64((1 << POSITION_BITS) - 1)
    elected = (_sliding_min((name & ~low) | np.arange(n, dtype=np.uint64), WINDOW) & low).astype(np.int64)
    valid = np.zeros(len(data) + 1, np.int8)
    np.add.at(valid, first, 1)
    np.add.at(valid, first + sizes - LENGTH + 1, -1)
    start = np.flatnonzero(np.cumsum(valid[:-1]))
    piece = np.searchsorted(first, start, side="right") - 1
    place = elected[start]
    edge = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (piece[1:] != piece[:-1]))))
    count = np.diff(np.append(edge, len(start)))
    lo, piece = start[edge], piece[edge]
    whole = range_hash(prefix, lo, lo + count - 1 + LENGTH)
    return piece, lo, count, name[place[edge]], whole


SINGLE, LEADER, REMOVED = 0, 1, 2
HOT_NAME = 4                # added to the flag of a run


def _is_hot(name: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which names are among the sorted hot ones."""
    if not len(hot):
        return np.zeros(len(name), bool)
    return hot[np.minimum(np.searchsorted(hot, name), len(hot) - 1)] == name


def hot_names(named: DataFrame, size: int) -> np.ndarray:
    """Sorted names with many runs in a sample of the texts, by a hash of the row."""
    def run(batches):
        for pdf in batches:
            for block in _joined(pdf["row"], utf8(pdf["text"])):
                name, n = np.unique(runs_of(block)[3], return_counts=True)
                yield pd.DataFrame({"name": name.view(np.int64), "n": n.astype(np.int64)})

    least = max(HOT, size // SAMPLE // (WINDOW // 2) // HOT_NAMES)
    found = (named.where(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0).mapInPandas(run, "name long, n long")
             .groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("name").collect())
    return np.sort(np.array([r["name"] for r in found], np.int64).view(np.uint64))


def _pack(bucket, row, name, whole, start, count, flag):
    """(bucket, blob) rows of run entries."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
        i = order[a:b]
        yield int(bucket[i[0]]), b"".join((
            np.uint32(len(i)).tobytes(), row[i].tobytes(), whole[i].tobytes(), name[i].astype(np.uint32).tobytes(),
            start[i].astype(np.uint32).tobytes(), count[i].astype(np.uint8).tobytes(), flag[i].astype(np.uint8).tobytes()))


def _unpack(blob: bytes):
    n, at, out = int(np.frombuffer(blob, np.uint32, 1)[0]), 4, []
    for kind in (np.int64, np.uint64, np.uint32, np.uint32, np.uint8, np.uint8):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _emit_runs(n_buckets: int, hot: np.ndarray):
    def run(batches):
        for pdf in batches:
            parts = []
            for block in _joined(pdf["row"], utf8(pdf["text"])):
                piece, lo, count, name, whole = runs_of(block)
                at = block[2][piece] + lo - block[1][piece]
                parts.append((block[0][piece], name, whole, at, count))
            if not parts:
                continue
            row, name, whole, at, count = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((whole, name))
            same = (name[order][1:] == name[order][:-1]) & (whole[order][1:] == whole[order][:-1])
            flag = np.zeros(len(row), np.int64)
            flag[order[1:][same]] = REMOVED                     # equal to an earlier run of the batch
            flag[order[:-1][same & ~np.concatenate(([False], same[:-1]))]] = LEADER
            hot_run = _is_hot(name, hot)
            dealt = np.where(hot_run, mix64(name ^ mix64(whole)), name) >> np.uint64(32)
            bucket = np.where(flag == REMOVED, mix64(row.view(np.uint64)), dealt) % np.uint64(n_buckets)
            flag += HOT_NAME * hot_run
            out = list(_pack(bucket.astype(np.int64), row, name, whole, at, count, flag))
            for a in range(0, len(out), 64):
                yield pd.DataFrame(out[a:a + 64], columns=["bucket", "blob"])
    return run


DONE, OPEN, OPEN_HOT = 1, 2, 3


def _rank_runs(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: runs past the threshold (DONE) and runs to go on with (OPEN)."""
    row, whole, name, start, count, flag = (np.concatenate(x) for x in zip(*map(_unpack, pdf["blob"])))
    hot, flag = flag & HOT_NAME > 0, flag & ~np.uint8(HOT_NAME)
    done = flag == REMOVED
    live = np.flatnonzero(~done)
    order = live[np.lexsort((whole[live], name[live]))]
    if len(order):
        new_name = np.concatenate(([True], name[order][1:] != name[order][:-1]))
        new_whole = new_name | np.concatenate(([True], whole[order][1:] != whole[order][:-1]))
        head = np.flatnonzero(new_whole)
        size = np.diff(np.append(head, len(order)))
        repeated = (size > 1) | (flag[order[head]] == LEADER)
        if len(head):                       # a leader may stand anywhere among equals
            led = np.maximum.reduceat((flag[order] == LEADER).astype(np.int8), head) > 0
            repeated = (size > 1) | led
        klass = np.cumsum(new_name)[head] - 1
        contexts = np.bincount(klass)[klass]            # different runs with this name
        alone = np.bincount(klass, weights=~repeated)[klass]
        done[order[np.repeat(repeated, size)]] = True
        # Unique runs of a repeated name go on, with one of each repeated run to meet.
        # Of hot names all different runs do: the others may be in any bucket.
        go = head[(contexts > 1) & (~repeated | (alone > 0)) | hot[order[head]]]
        opened = order[go]
    else:
        opened = order
    kind = np.concatenate((np.full(int(done.sum()), DONE), np.where(hot[opened], OPEN_HOT, OPEN)))
    pick = np.concatenate((np.flatnonzero(done), opened)).astype(np.int64)
    return pd.DataFrame({"kind": kind.astype(np.int32), "row": row[pick], "start": start[pick].astype(np.int32),
                         "n": count[pick].astype(np.int32), "name": name[pick].astype(np.int64)})


def _emit_strings(n_buckets: int):
    """Runs of a text -> names of all their 200-byte strings, dealt by the run's
    name (``spread`` 0), or by their own if that is hot (``spread`` 1)."""
    half = LENGTH // 2

    def run(batches):
        codes = byte_codes()
        for pdf in batches:
            buckets: dict[int, list[bytes]] = {}
            spread: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for row, raw, runs in zip(pdf["row"], utf8(pdf["text"]), pdf["runs"]):
                for r in runs:
                    begin, n = int(r["start"]), int(r["n"])
                    data = np.frombuffer(raw, np.uint8, n - 1 + LENGTH, begin)
                    prefix = prefix_hash(data, codes)
                    p = np.arange(n)
                    a, b = range_hash(prefix, p, p + half), range_hash(prefix, p + half, p + LENGTH)
                    pair = mix64(a * BASE + b)
                    if r["kind"] == OPEN_HOT:
                        spread.append((np.full(n, row, np.int64), begin + p, pair))
                        continue
                    buckets.setdefault(int(r["name"]) % n_buckets, []).append(
                        np.array([row, begin, n], np.int64).tobytes() + pair.tobytes())
            rows = [(k, 0, b"".join(v)) for k, v in buckets.items()]
            if spread:
                rows += _spread(n_buckets, *(np.concatenate(x) for x in zip(*spread)))
            for a in range(0, len(rows), 64):
                yield pd.DataFrame(rows[a:a + 64], columns=["bucket", "spread", "blob"])
    return run


def _spread(n_buckets: int, row: np.ndarray, start: np.ndarray, pair: np.ndarray):
    """(bucket, 1, blob) rows of single strings; of equal ones in the batch one
    is the leader, the others are known to repeat and pass by bucket of rows."""
    order = np.argsort(pair, kind="stable")
    same = pair[order][1:] == pair[order][:-1]
    flag = np.zeros(len(row), np.int64)
    flag[order[1:][same]] = REMOVED
    flag[order[:-1][same & ~np.concatenate(([False], same[:-1]))]] = LEADER
    bucket = (np.where(flag == REMOVED, mix64(row.view(np.uint64)), mix64(pair)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
        i = order[a:b]
        yield int(bucket[i[0]]), 1, b"".join((np.uint32(len(i)).tobytes(), row[i].tobytes(), pair[i].tobytes(),
                                              start[i].astype(np.uint32).tobytes(), flag[i].astype(np.uint8).tobytes()))


def _rank_spread(blobs) -> pd.DataFrame:
    """One bucket's single strings: row, start, n of those that repeat, neighbours joined."""
    parts: list[list[np.ndarray]] = []
    for blob in blobs:
        n, at, found = int(np.frombuffer(blob, np.uint32, 1)[0]), 4, []
        for kind in (np.int64, np.uint64, np.uint32, np.uint8):
            found.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
        parts.append(found)
    row, pair, start, flag = (np.concatenate(x) for x in zip(*parts))
    hit = flag != SINGLE
    live = np.flatnonzero(flag != REMOVED)
    order = live[np.argsort(pair[live], kind="stable")]
    same = pair[order][1:] == pair[order][:-1]
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    row, start = row[hit], start[hit].astype(np.int64)
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    edge = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] - start[:-1] > 1)))[:len(row)])
    last = np.append(edge[1:], len(row))[:len(edge)] - 1
    return pd.DataFrame({"row": row[edge], "start": start[edge].astype(np.int32),
                         "n": (start[last] - start[edge] + 1).astype(np.int32)})


def _rank_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    apart = pdf["spread"] == 1
    out = [rank(pdf["blob"][mine]) for mine, rank in ((~apart, _rank_strings), (apart, _rank_spread)) if mine.any()]
    return pd.concat(out)


def _rank_strings(blobs) -> pd.DataFrame:
    """One bucket: intervals of positions whose 200-byte string repeats."""
    rows, starts, sizes, pairs = [], [], [], []
    for blob in blobs:
        at = 0
        while at < len(blob):
            row, begin, n = np.frombuffer(blob, np.int64, 3, at).tolist()
            pairs.append(np.frombuffer(blob, np.uint64, n, at + 24))
            rows.append(row), starts.append(begin), sizes.append(n)
            at += 24 + 8 * n
    pair = np.concatenate(pairs)
    order = np.argsort(pair, kind="stable")
    same = pair[order][1:] == pair[order][:-1]
    again = np.zeros(len(pair), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    owner = np.repeat(np.arange(len(rows)), sizes)
    hit = np.flatnonzero(again)
    if not len(hit):
        return pd.DataFrame({"row": np.zeros(0, np.int64), "start": np.zeros(0, np.int32), "n": np.zeros(0, np.int32)})
    first = np.flatnonzero(np.concatenate(([True], (np.diff(hit) != 1) | (np.diff(owner[hit]) != 0))))
    n = np.diff(np.append(first, len(hit)))
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    o = owner[hit[first]]
    return pd.DataFrame({"row": np.array(rows, np.int64)[o],
                         "start": (np.array(starts)[o] + hit[first] - base[o]).astype(np.int32), "n": n.astype(np.int32)})


def repeated_strings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, start, n: n neighbouring positions from start whose LENGTH-byte
    strings also start elsewhere."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    named = docs.select(_row(key, text), F.col(text).alias("text"))
    ranked = cut_lineage(named.mapInPandas(_emit_runs(n_buckets, hot_names(named, size)), "bucket int, blob binary")
                         .groupBy("bucket").applyInPandas(_rank_runs, "kind int, row long, start int, n int, name long"))
    open_ = (ranked.where(F.col("kind") != DONE).groupBy("row")
             .agg(F.collect_set(F.struct("start", "n", "name", "kind")).alias("runs")))
    strings = (named.join(open_, "row").mapInPandas(_emit_strings(n_buckets), "bucket int, spread int, blob binary")
               .groupBy("bucket").applyInPandas(_rank_bucket, "row long, start int, n int"))
    return ranked.where(F.col("kind") == DONE).select("row", "start", "n").unionByName(strings)


def _spans(found) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["start"] + x["n"] - 1 + LENGTH) for x in found):
        if out and out[-1][1] >= s:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", column: str = "dedup") -> DataFrame:
    """``docs`` with struct<n_bytes, n_removed, n_spans, kept, kept_sha256>."""
    own, extra = free_name(docs, "__row"), free_name(docs, "__found")
    found = repeated_strings(docs, key, text).groupBy("row").agg(F.collect_set(F.struct("start", "n")).alias(extra))

    def cut(text: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for raw, f in zip(utf8(text), found):
            spans = _spans(f) if f is not None else []
            at, parts = 0, []
            for s, e in spans:
                parts.append(raw[at:s])
                at = e
            kept = b"".join([*parts, raw[at:]])
            rows.append((len(raw), len(raw) - len(kept), len(spans), kept, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    joined = (docs.withColumn(own, _row(key, text))
              .join(found.withColumnRenamed("row", own), own, "left"))
    made = F.pandas_udf(cut, "n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return joined.withColumn(column, made(F.col(text), F.col(extra))).select(*[c for c in docs.columns if c.lower() != column.lower()], column)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[F.col(f"dedup.{c}") for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
