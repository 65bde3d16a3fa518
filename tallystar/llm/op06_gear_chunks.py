"""Substring deduplication by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of each text; a chunk ends where
``MASK`` bits of the hash are zero (never inside a character), at least
``MIN_CHUNK`` and at most about ``MAX_CHUNK`` bytes after the last end. The
cut depends on the last 16 bytes only, so an insertion shifts no chunk but
its neighbours. What is compared are joined runs: for every chunk the shortest
run of chunks of ``MIN_SPAN`` bytes or more that ends with it, and the run that
starts the text; a text under ``MIN_SPAN`` bytes is one run. Of runs with
equal 128-bit digests the copy with the smallest (row hash, position) stays,
the bytes of the others are removed. So every removed byte lies in a repeated
passage of ``MIN_SPAN`` bytes or a repeated whole text, exact copies go whole,
and of every chunk the first copy stays (an earlier equal run holds an earlier
copy of each of its chunks).

Limits: of a repeated passage inside a text the bytes before the first common
cut and after the last stay; a text under ``MIN_SPAN`` bytes goes as a copy of
a whole text only, not of a part of a longer one.

Scale: runs travel once, packed by bucket of digests, 29 bytes for a chunk of
about 24; equal runs of one batch are combined before the shuffle, so a hot
run costs one entry for each batch and not one for each text. Removed runs are
gathered per document, never per digest. Texts are shuffled once, for the
final cut.

Null and empty texts have no chunks and stay as they are. Repeated rows
(equal key and text) count as one record and all keep or lose the same
bytes. Extra columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.batches import bound_batches
from tallystar.llm.hashing import mix64, text_runs, utf8
from tallystar.llm.names import free_name
from tallystar.sources.testdata import read_table

MIN_CHUNK = 8
MAX_CHUNK = 128
MASK = np.uint16(0b1111 << 12)      # 4 bits: 16 bytes beyond the minimum on average
MIN_SPAN = 96
PIECE = 1 << 21
BUCKET_BYTES = 20_000_000           # text bytes per bucket of digests


def gear_codes() -> np.ndarray:
    return (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) & np.uint64(0xFFFF)).astype(np.uint16)


def cut_points(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Ends allowed by content: the low 16 bits of the gear hash of the bytes
    before the end (they depend on 16 bytes) have their MASK bits zero, and
    the next byte starts a character."""
    h = codes[data]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width] << np.uint16(width)      # right side is evaluated first
    ends = np.flatnonzero((h & MASK) == 0) + 1
    ends = ends[ends < len(data)]
    return ends[(data[ends] & 0xC0) != 0x80]


def chunk_ends(raw: bytes, codes: np.ndarray) -> list[int]:
    """Ends of the chunks of one text (in pieces, so memory is bounded)."""
    size = len(raw)
    if not size:
        return []
    out: list[int] = []
    last = at = 0
    while at < size:
        stop = min(size, at + PIECE)
        lead = min(at, 15)
        data = np.frombuffer(raw, np.uint8, min(size, stop + 1) - at + lead, at - lead)
        for end in (cut_points(data, codes) + (at - lead)).tolist():
            if end <= at and at:
                continue
            while end - last > MAX_CHUNK:
                last = _character(raw, last + MAX_CHUNK)
                out.append(last)
            if end - last >= MIN_CHUNK:
                out.append(end)
                last = end
        at = stop
    while size - last > MAX_CHUNK:
        last = _character(raw, last + MAX_CHUNK)
        out.append(last)
    if last < size:
        out.append(size)
    return out


def _character(raw: bytes, at: int) -> int:
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


def runs_of(ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of chunks that are compared."""
    e = np.array(ends, np.int64)
    if not len(e):
        return e, e
    begin = np.concatenate(([0], e[:-1]))
    if e[-1] < MIN_SPAN:
        return begin[:1], e[-1:]
    stop = e[e >= MIN_SPAN]
    start = begin[np.searchsorted(begin, stop - MIN_SPAN, side="right") - 1]
    return (start, stop) if start[0] == 0 else (np.append(0, start), np.append(stop[0], stop))


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Row, start and end of the union of intervals, per row."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    fresh = np.concatenate(([True], row[1:] != row[:-1]))
    group = np.cumsum(fresh)
    # Ends only grow within a row: the running maximum, kept apart by row.
    far = np.maximum.accumulate(end + (group << np.int64(32))) - (group << np.int64(32))
    edge = np.flatnonzero(np.concatenate(([True], fresh[1:] | (start[1:] > far[:-1]))))
    return row[edge], start[edge], far[np.append(edge[1:], len(row)) - 1]


def _extra_runs(row: np.ndarray, d: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each equal run by (row, start), and all others but that
    same place in a repeated row."""
    order = np.lexsort((start, row, d[:, 1], d[:, 0]))
    o = d[order]
    fresh = np.concatenate(([True], (o[1:] != o[:-1]).any(axis=1)))
    first = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    other = (row[order] != row[first]) | (start[order] != start[first])
    return order[fresh], order[other]


def _emit(n_buckets: int):
    """Texts -> packed runs by bucket of digests (``extra`` 0), and the runs that
    repeat an earlier one of the batch by bucket of rows (``extra`` 1)."""
    def run(batches):
        codes = gear_codes()
        for pdf in batches:
            texts, names = utf8(pdf["text"]), pdf["row"].to_numpy(np.int64)
            for lo, hi in text_runs(texts, 4 * PIECE):
                rows, starts, stops, digests = [], [], [], []
                for name, raw in zip(names[lo:hi].tolist(), texts[lo:hi]):
                    start, stop = runs_of(chunk_ends(raw, codes))
                    rows.append(np.full(len(start), name, np.int64))
                    starts.append(start)
                    stops.append(stop)
                    digests.append(b"".join([hashlib.blake2b(raw[s:e], digest_size=16).digest()
                                             for s, e in zip(start.tolist(), stop.tolist())]))
                d = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
                if not len(d):
                    continue
                row, start, stop = np.concatenate(rows), np.concatenate(starts), np.concatenate(stops)
                first, other = _extra_runs(row, d, start)
                out = [(0, *x) for x in _pack(
                    d[first, 0] % np.uint64(n_buckets), d[first, 0], d[first, 1], row[first],
                    start[first].astype(np.uint32), (stop - start)[first].astype(np.uint8))]
                if len(other):
                    r, s, e = _merged(row[other], start[other], stop[other])
                    out += [(1, *x) for x in _pack(mix64(r.view(np.uint64)) % np.uint64(n_buckets), r,
                                                   s.astype(np.uint32), (e - s).astype(np.uint32))]
                for a in range(0, len(out), 256):
                    yield pd.DataFrame(out[a:a + 256], columns=["extra", "bucket", "blob"])
    return run


def _pack(bucket: np.ndarray, *columns: np.ndarray):
    """(bucket, blob) rows: the number of entries and the columns."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
        i = order[a:b]
        yield int(bucket[i[0]]), np.uint32(len(i)).tobytes() + b"".join(c[i].tobytes() for c in columns)


def _unpack(blobs, *kinds):
    out = [[] for _ in kinds]
    for blob in blobs:
        n, at = int(np.frombuffer(blob, np.uint32, 1)[0]), 4
        for held, kind in zip(out, kinds):
            held.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(held) if held else np.zeros(0, kind) for held, kind in zip(out, kinds)]


def _judge(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: the places to remove."""
    d1, d2, row, start, size = _unpack(pdf["blob"][pdf["extra"] == 0], np.uint64, np.uint64, np.int64, np.uint32, np.uint8)
    passed = _unpack(pdf["blob"][pdf["extra"] == 1], np.int64, np.uint32, np.uint32)
    if len(row):
        _, other = _extra_runs(row, np.stack((d1, d2), axis=1), start)
        passed = [np.concatenate((x, y[other])) for x, y in zip(passed, (row, start, size.astype(np.uint32)))]
    return pd.DataFrame({"row": passed[0], "start": passed[1].astype(np.int32), "size": passed[2].astype(np.int32)})


def redundant(docs: DataFrame, text: str, row: str) -> DataFrame:
    """row and its redundant runs, array<struct<start, size>>."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n_buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    return (docs.select(F.col(row).alias("row"), F.col(text).alias("text"))
            .mapInPandas(_emit(n_buckets), "extra int, bucket int, blob binary")
            .groupBy("bucket").applyInPandas(_judge, "row long, start int, size int")
            .groupBy("row").agg(F.collect_set(F.struct("start", "size")).alias("__extra")))


def spans_of(extra) -> list[tuple[int, int]]:
    """Redundant runs, joined where they overlap or adjoin."""
    out: list[list[int]] = []
    for s, n in sorted((x["start"], x["size"]) for x in extra if x is not None):
        if out and out[-1][1] >= s:
            out[-1][1] = max(out[-1][1], s + n)
        else:
            out.append([s, s + n])
    return [(s, e) for s, e in out]


def _cut(text: pd.Series, extra: pd.Series) -> pd.DataFrame:
    rows = []
    for t, raw, found in zip(text, utf8(text), extra):
        spans = spans_of(found) if found is not None and len(found) else []
        at, kept = 0, []
        for s, e in spans:
            kept.append(raw[at:s])
            at = e
        rows.append((len(raw), sum(e - s for s, e in spans), len(spans),
                     t if not spans else b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")))
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "text"])


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", column: str = "chunked") -> DataFrame:
    """``docs`` with struct<n_bytes, n_removed, n_spans, text>: what is left
    after repeated runs of chunks are removed."""
    own, extra = free_name(docs, "__row"), free_name(docs, "__extra")
    named = docs.withColumn(own, F.xxhash64(F.col(key).cast("string"), F.col(text)))
    joined = named.join(redundant(named, text, own).withColumnsRenamed({"row": own, "__extra": extra}), own, "left")
    cut = F.pandas_udf(_cut, "n_bytes long, n_removed long, n_spans long, text string")
    return joined.withColumn(column, cut(F.col(text), F.col(extra))).select(
        *[c for c in docs.columns if c.lower() != column.lower()], column)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = deduplicate(docs).select("doc_id", "chunked.*")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
                      (F.col("n_removed") > 0).alias("has_repeat"), "text")
