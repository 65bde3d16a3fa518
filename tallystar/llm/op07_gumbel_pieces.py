"""Piece encoding with sampled segmentations, and decoding.

For each text the operator draws ``k`` distinct segmentations into vocabulary
pieces, without replacement and in proportion to their probability: Gumbel
top-k, run as a perturbed A-star search. The lattice of a text has an edge
for every piece at every position; backward sums give the probability of each
edge. The search keeps an agenda of disjoint sets of segmentations ("the same
edges up to step t, another edge at t"), each with the perturbed arrival time
of its best member; the root's time is drawn first, a set's time is its
parent's plus an exponential variate over its mass. Taking the earliest set
and completing it edge by edge gives the next distinct segmentation; the time
of the first set left over gives the inclusion scores of those emitted.

The model's vocabulary files hold merge ranks as scores; a rank r counts as
log probability -log(r + RANK_SHIFT) ("rank"), or scores are used as they are
("logprob"). Pieces never cross a word start, so the lattice splits into words
and equal words of a batch share theirs. Texts are handled whole, in numpy
over batches of bounded size; nothing is shuffled; the vocabulary (its size is
fixed by the model file) is broadcast. Every draw is a hash of the row key,
so results do not depend on partitions.

Encoding is lossless: characters outside the vocabulary become byte pieces,
a literal word-start mark becomes bytes too, and decoding returns the text. A
null text has no segmentations (an empty array), the empty text has one empty
segmentation; texts with fewer than k segmentations give all of them, each
with inclusion score 1 (logarithm 0). Equal keys draw alike; extra columns
pass through whatever their names (one of the result's name is replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.batches import bound_batches, tidy
from tallystar.llm.hashing import BASE, mix64, prefix_hash_codes, range_hash
from tallystar.llm.names import free_name
from tallystar.sources.testdata import read_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
SAMPLES = 2
RANK_SHIFT = 10.0
SUB_BATCH = 1 << 19         # code points per vectorised step
SLOT_BITS = 20
NEGLIGIBLE = 60.0
LITERAL_MARK = 0x110000     # stands for a mark that is text: matches no piece


def load_vocabulary(path: str = MODEL, scores: str = "rank") -> dict:
    """Pieces of a model file as arrays; raises if a piece crosses a word start."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    pieces, ids, logp = [], [], []
    byte_ids = np.full(256, -1, np.int32)
    raw = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            raw.append(bytes([int(piece[3:5], 16)]))
            continue
        raw.append(piece.replace(MARK, " ").encode())
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"piece {piece!r} crosses a word start")
        pieces.append(piece)
        ids.append(i)
        logp.append(sp.get_score(i))
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    logp = np.array(logp)
    if scores == "rank":
        logp = -np.log(np.argsort(np.argsort(-logp, kind="stable"), kind="stable") + RANK_SHIFT)
    order = np.log(len(pieces) + 256 + RANK_SHIFT)
    return {"pieces": pieces, "ids": np.array(ids, np.int32), "logp": logp, "byte_ids": byte_ids,
            "byte_logp": float(min(logp.min(), -order)), "raw": raw}


def _code(cp: np.ndarray) -> np.ndarray:
    return mix64(cp.astype(np.uint64) + np.uint64(1))


class Trie:
    """Hash table of all prefixes of all pieces (code point sequences)."""

    def __init__(self, vocabulary: dict):
        number: dict[str, int] = {}
        piece_at: list[int] = []
        for j, piece in enumerate(vocabulary["pieces"]):
            for n in range(1, len(piece) + 1):
                at = number.setdefault(piece[:n], len(piece_at))
                if at == len(piece_at):
                    piece_at.append(-1)
            piece_at[number[piece]] = j
        joined = np.frombuffer("".join(number).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(x) for x in number], dtype=np.int64)
        end = np.cumsum(size)
        self.hash = range_hash(prefix_hash_codes(_code(joined)), end - size, end)
        self.piece = np.array(piece_at, np.int32)
        self.longest = int(size.max())
        slot = (self.hash >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.table = np.full(1 << SLOT_BITS, -1, np.int32)
        self.table[slot[::-1]] = np.arange(len(slot), dtype=np.int32)[::-1]
        over = np.flatnonzero(self.table[slot] != np.arange(len(slot)))
        over = over[np.argsort(self.hash[over])]
        self.over_hash, self.over = self.hash[over], over
        self.crowded = np.zeros(1 << SLOT_BITS, bool)
        self.crowded[slot[over]] = True
        self.ids, self.logp = vocabulary["ids"], vocabulary["logp"]
        self.byte_logp = vocabulary["byte_logp"]
        self.n_ids = len(vocabulary["raw"])

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at = self.table[slot]
        hit = (at >= 0) & (self.hash[at] == h)
        out = np.where(hit, at, -1)
        rest = np.flatnonzero(~hit & self.crowded[slot])
        if len(rest):
            j = np.searchsorted(self.over_hash, h[rest])
            j[j == len(self.over_hash)] = 0
            good = self.over_hash[j] == h[rest]
            out[rest[good]] = self.over[j[good]]
        return out


class Lattice:
    """Lattices of distinct words. Nodes are numbered by their distance to the
    word's end, so backward sums run level by level; ``n`` is the end node."""

    def __init__(self, trie: Trie, cp: np.ndarray, start: np.ndarray, end: np.ndarray):
        n = len(cp)
        left = (np.repeat(end, end - start) - np.arange(n)).astype(np.int64)
        prefix = prefix_hash_codes(_code(cp))
        active = np.arange(n)
        found = []
        single = np.zeros(n, bool)
        for size in range(1, trie.longest + 1):
            active = active[left[active] >= size]
            if not len(active):
                break
            entry = trie.find(range_hash(prefix, active, active + size))
            active, entry = active[entry >= 0], entry[entry >= 0]
            piece = trie.piece[entry]
            has = piece >= 0
            if size == 1:
                single[active[has]] = True
            found.append((active[has], size, trie.ids[piece[has]], trie.logp[piece[has]]))
        alone = np.flatnonzero(~single)
        width = 1 + (cp[alone] > 0x7F) + (cp[alone] > 0x7FF) + ((cp[alone] > 0xFFFF) & (cp[alone] < LITERAL_MARK)) * 1
        found.append((alone, 1, (trie.n_ids + cp[alone]).astype(np.int32), width * trie.byte_logp))
        order = np.argsort(left.astype(np.uint16) if int(left.max(initial=0)) < 1 << 16 else left, kind="stable")
        rank = np.empty(n, np.int32)
        rank[order] = np.arange(n, dtype=np.int32)
        count = np.zeros(n, np.int32)
        ranks = [rank[at] for at, _, _, _ in found]
        for r in ranks:
            count[r] += 1
        first = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        filled = first[:-1].copy()
        total = int(first[-1])
        self.to, self.id = np.full(total, n, np.int32), np.empty(total, np.int32)
        weight = np.empty(total)
        for r, (at, size, ids, lp) in zip(ranks, found):
            e = filled[r]
            filled[r] += 1
            inner = np.flatnonzero(left[at] > size)
            self.to[e[inner]] = rank[at[inner] + size]
            self.id[e], weight[e] = ids, lp
        beta = np.zeros(n + 1)
        self.p = np.empty(total)          # probability of each edge at its node
        level = np.searchsorted(left[order], np.arange(1, int(left.max(initial=0)) + 2))
        for a, b in zip(level[:-1].tolist(), level[1:].tolist()):
            if a == b:
                continue
            lo, hi = first[a], first[b]
            x = weight[lo:hi] + beta[self.to[lo:hi]]
            cut = first[a:b] - lo
            high = np.maximum.reduceat(x, cut)
            x = np.exp(x - np.repeat(high, count[a:b]))
            mass = np.add.reduceat(x, cut)
            beta[a:b] = high + np.log(mass)
            self.p[lo:hi] = x / np.repeat(mass, count[a:b])
        # Draws take the likeliest edge of a node first, then the others in order.
        best = np.maximum.reduceat(self.p, first[:-1]) if n else self.p
        owner = np.repeat(np.arange(n, dtype=np.int32), count)
        is_top = np.flatnonzero(self.p == best[owner])
        self.top = np.empty(n, np.int64)
        self.top[owner[is_top[::-1]]] = is_top[::-1]
        self.p_top = np.where(count == 1, 1.0, best)
        self.first, self.n, self.entry = first, n, rank[start].astype(np.int64)

    def walk(self, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sample from each node to its word's end: (walker, edge) pairs in
        order of walker and step."""
        who, edges, steps = [], [], []
        index = np.flatnonzero(node < self.n)
        at, key, step = node[index], seed[index], 0
        while len(index):
            turn = np.uint64((step + 1) * int(BASE) & (1 << 64) - 1)
            u = (mix64(key + turn) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            e = self.top[at]
            limit = self.p_top[at]
            rare = np.flatnonzero(u >= limit)
            left = u[rare] - limit[rare]
            edge, stop, skip = self.first[at[rare]], self.first[at[rare] + 1] - 1, e[rare]
            while len(rare):
                left -= np.where(edge == skip, 0.0, self.p[edge])
                e[rare] = np.where(edge == skip, e[rare], edge)      # rounding ends at the last other edge
                go = np.flatnonzero((left >= 0) & (edge < stop))
                rare, left, edge, stop, skip = rare[go], left[go], edge[go] + 1, stop[go], skip[go]
            who.append(index)
            edges.append(e)
            steps.append(np.full(len(e), step, np.int64))
            at = self.to[e]
            go = at < self.n
            index, at, key, step = index[go], at[go], key[go], step + 1
        if not who:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        used = np.bincount(np.concatenate(who), minlength=len(node))
        offset = np.concatenate(([0], np.cumsum(used)))
        out = np.empty(int(offset[-1]), np.int64)
        for w, e, s in zip(who, edges, steps):
            out[offset[w] + s] = e
        return np.repeat(np.arange(len(node)), used), out


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((mix64(seed) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


class _Sample:
    """One segmentation of one text: its edges, the word of each, and the log
    arrival times of the sets that differ from it first at step ``since``,
    ``since`` + 1 and so on. ``barred``: edges already taken at step ``since``."""

    __slots__ = ("edges", "word", "logp", "open", "since", "barred")

    def __init__(self, edges, word, since, barred):
        self.edges, self.word, self.since, self.barred = edges, word, since, barred


def _open_sets(samples: list[_Sample], lattice: Lattice, log_time: np.ndarray, seed: np.ndarray) -> None:
    """Set ``logp`` and ``open`` of one new sample per text. Sets of mass below
    exp(-NEGLIGIBLE) never arrive."""
    size = np.array([len(s.edges) for s in samples])
    bound = np.concatenate(([0], np.cumsum(size)))
    lp = np.log(lattice.p[np.concatenate([s.edges for s in samples])])
    total = np.concatenate(([0.0], np.cumsum(lp)))
    before = total[:-1] - np.repeat(total[bound[:-1]], size)
    step = np.arange(len(lp)) - np.repeat(bound[:-1], size)
    since = np.array([s.since for s in samples])
    kept = np.flatnonzero((before > -NEGLIGIBLE) & (step >= np.repeat(since, size)))
    owner = np.repeat(np.arange(len(samples)), size)[kept]
    cut = np.searchsorted(owner, np.arange(len(samples) + 1))
    with np.errstate(divide="ignore"):
        mass = before[kept] + np.log(-np.expm1(lp[kept]))
        for j, s in enumerate(samples):
            if s.barred and cut[j] < cut[j + 1]:
                node = _node(lattice, s, s.since)
                rest = 1.0 - sum(float(lattice.p[e]) for e in s.barred)
                more = lattice.first[node + 1] - lattice.first[node] > len(s.barred)
                mass[cut[j]] = before[kept[cut[j]]] + np.log(rest) if more and rest > 1e-15 else -np.inf
        u = _uniform(seed[owner] + step[kept].astype(np.uint64) * BASE)
        arrival = np.logaddexp(log_time[owner], np.log(-np.log(u)) - mass)
    for j, s in enumerate(samples):
        s.logp = float(total[bound[j + 1]] - total[bound[j]])
        s.open = arrival[cut[j]:cut[j + 1]]


def _node(lattice: Lattice, sample: _Sample, t: int) -> int:
    return int(np.searchsorted(lattice.first, sample.edges[t], side="right") - 1)


def sample_texts(trie: Trie, texts: list, seeds: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text its segmentations: (piece numbers, log probability, log
    inclusion score), in order of arrival."""
    mark = ord(MARK)
    which = [i for i, t in enumerate(texts) if t]
    out: list = [[] if t is None else [(np.zeros(0, np.int32), 0.0, 0.0)] for t in texts]
    if not which:
        return out
    arrays = []
    for i in which:
        cp = np.frombuffer((" " + texts[i]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        cp[cp == mark] = LITERAL_MARK
        cp[cp == 32] = mark
        arrays.append(cp)
    cp = np.concatenate(arrays)
    size = np.array([len(a) for a in arrays], dtype=np.int64)
    doc_start = np.concatenate(([0], np.cumsum(size)[:-1]))
    new = (cp == mark) & (np.concatenate(([0], cp[:-1])) != mark)
    new[doc_start] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(cp))
    doc = np.searchsorted(doc_start, start, side="right") - 1
    _, one, same = np.unique(range_hash(prefix_hash_codes(_code(cp)), start, end), return_index=True, return_inverse=True)
    length = (end - start)[one]
    w_end = np.cumsum(length)
    w_start = w_end - length
    take = np.repeat(start[one] - w_start, length) + np.arange(int(w_end[-1]))
    lattice = Lattice(trie, cp[take], w_start, w_end)
    entry = lattice.entry[same]
    doc_seed = mix64(seeds[np.array(which)].astype(np.int64).view(np.uint64) + np.uint64(0x5EED))
    place = np.arange(len(start)) - np.searchsorted(doc, np.arange(len(which)))[doc]
    word_seed = mix64(doc_seed[doc] + place.astype(np.uint64) * BASE)
    words_of = np.append(np.searchsorted(doc, np.arange(len(which))), len(start))

    who, edge = lattice.walk(entry, mix64(word_seed + np.uint64(1)))     # each text's best member
    bound = np.searchsorted(doc[who], np.arange(len(which) + 1))
    state = [[_Sample(edge[a:b], who[a:b], 0, [])] for a, b in zip(bound[:-1], bound[1:])]
    _open_sets([x[0] for x in state], lattice, np.log(-np.log(_uniform(doc_seed + np.uint64(2)))), doc_seed + np.uint64(3))
    for turn in range(1, k):
        nodes, parts = [], []
        draw = _uniform(doc_seed + np.uint64(turn * 1_000_003 + 11))
        for d, samples in enumerate(state):
            best = _earliest(samples)
            if best is None:
                continue
            log_time, s, t = best
            node = _node(lattice, s, t)
            barred = s.barred if s.barred and t == s.since else [int(s.edges[t])]
            free = [e for e in range(int(lattice.first[node]), int(lattice.first[node + 1])) if e not in barred]
            p = lattice.p[free].tolist()
            left, pick = draw[d] * sum(p), free[-1]
            for e, mass in zip(free, p):
                left -= mass
                if left < 0:
                    pick = e
                    break
            s.open[t - s.since] = np.inf
            word = int(s.word[t])
            begin = entry[word:words_of[d + 1]].copy()
            begin[0] = lattice.to[pick]
            nodes.append(begin)
            parts.append((d, s, t, pick, [*barred, pick], log_time, word))
        if not parts:
            break
        ahead = np.concatenate(([0], np.cumsum([len(x) for x in nodes])))
        key = np.concatenate([word_seed[x[-1]:words_of[x[0] + 1]] for x in parts]) + np.uint64(turn * 7 + 1)
        who, edge = lattice.walk(np.concatenate(nodes), mix64(key))
        cut = np.searchsorted(who, ahead)
        fresh = []
        for j, (d, s, t, pick, barred, log_time, word) in enumerate(parts):
            a, b = cut[j], cut[j + 1]
            fresh.append(_Sample(np.concatenate((s.edges[:t], [pick], edge[a:b])),
                                 np.concatenate((s.word[:t + 1], who[a:b] - ahead[j] + word)), t, barred))
            state[d].append(fresh[-1])
        _open_sets(fresh, lattice, np.array([x[5] for x in parts]),
                   doc_seed[[x[0] for x in parts]] + np.uint64(turn * 999_983 + 5))
    for d, samples in enumerate(state):
        last = _earliest(samples)
        out[which[d]] = [(lattice.id[s.edges], s.logp, _log_inclusion(s.logp + last[0] if last else np.inf))
                         for s in samples]
    return out


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x)))."""
    if x > 4:
        return 0.0
    if x < -30:
        return float(x)
    return float(np.log(-np.expm1(-np.exp(x))))


def _earliest(samples: list[_Sample]):
    """(log time, sample, step) of the first set on the agenda."""
    best = None
    for s in samples:
        if len(s.open):
            j = int(s.open.argmin())
            if s.open[j] < (best[0] if best else np.inf):
                best = (float(s.open[j]), s, s.since + j)
    return best


def _ids(edge_ids: np.ndarray, n_ids: int, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece numbers with characters outside the vocabulary as byte pieces, and
    where those of each edge begin (one more: the end)."""
    width = np.ones(len(edge_ids), np.int64)
    odd = np.flatnonzero(edge_ids >= n_ids)
    chars, which = np.unique(edge_ids[odd] - n_ids, return_inverse=True)
    coded = [(MARK if c == LITERAL_MARK else chr(c)).encode("utf-8", "surrogatepass") for c in chars.tolist()]
    width[odd] = np.array([len(x) for x in coded], np.int64)[which]
    begin = np.concatenate(([0], np.cumsum(width)))
    out = np.repeat(edge_ids.astype(np.int32), width)
    for k in range(max(map(len, coded), default=0)):
        byte = byte_ids[np.array([x[min(k, len(x) - 1)] for x in coded], np.int64)][which]
        wide = width[odd] > k
        out[begin[odd[wide]] + k] = byte[wide]
    return out, begin


def decode_ids(raw: list[bytes], ids) -> str:
    """Text of one segmentation: pieces joined, marks as spaces, the first one dropped."""
    return b"".join([raw[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


SEGMENTATION = "array<struct<ids:array<int>,logp:double,log_inclusion:double>>"


def _sub_batches(texts: list):
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t or "") + 1
        if held >= SUB_BATCH:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _as_arrow(rows: list, n_ids: int, byte_ids: np.ndarray) -> pa.Array:
    flat = [x for r in rows for x in r]
    edges = np.concatenate([x[0] for x in flat]) if flat else np.zeros(0, np.int32)
    ids, begin = _ids(edges, n_ids, byte_ids)
    inner = begin[np.concatenate(([0], np.cumsum([len(x[0]) for x in flat], dtype=np.int64)))].astype(np.int32)
    outer = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    values = pa.array(ids, pa.int32())
    item = pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(inner), values), pa.array(np.array([x[1] for x in flat], float)),
         pa.array(np.array([x[2] for x in flat], float))], ["ids", "logp", "log_inclusion"])
    return pa.ListArray.from_arrays(pa.array(outer), item)


def _round_trips(raw: list[bytes], samples: pa.Array, texts: list) -> pa.Array:
    """Whether all segmentations of a text decode to it."""
    joined, size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw])
    start = np.cumsum(size) - size
    ids, bounds = samples.flatten().field("ids"), samples.offsets.to_numpy()
    values, cuts = ids.values.to_numpy(), ids.offsets.to_numpy()

    def decoded(ids: np.ndarray) -> bytes:
        length = size[ids]
        end = np.cumsum(length)
        at = np.repeat(start[ids] - end + length, length)
        at += np.arange(len(at))
        return joined[at[1:]].tobytes()              # without the first mark

    out = []
    for text, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist()):
        own = None if text is None else text.encode("utf-8", "surrogatepass")
        out.append(None if text is None else all(decoded(values[cuts[j]:cuts[j + 1]]) == own for j in range(a, b)))
    return pa.array(out, pa.bool_())


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES, model: str = MODEL,
           scores: str = "rank", column: str = "samples", check: str | None = None,
           carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: all) with up to k distinct sampled
    segmentations of each text. ``check`` names a column that tells whether
    every one of them decodes to the text (null for a null text)."""
    bound_batches(docs.sparkSession)
    vocabulary = load_vocabulary(model, scores)
    # Built once; its size is fixed by the model file (about 10 MB).
    shared = docs.sparkSession.sparkContext.broadcast((Trie(vocabulary), vocabulary["byte_ids"], vocabulary["raw"]))

    def run(batches):
        trie, byte_ids, raw = shared.value
        for batch in batches:
            texts, seeds = batch.column(own_text).to_pylist(), np.asarray(batch.column(own_seed))
            rest = batch.select(kept)
            for a, b in _sub_batches(texts):
                rows = sample_texts(trie, texts[a:b], seeds[a:b], k)
                found = [_as_arrow(rows, trie.n_ids, byte_ids)]
                if check:
                    found.append(_round_trips(raw, found[0], texts[a:b]))
                yield pa.RecordBatch.from_arrays([*rest.slice(a, b - a).columns, *found], names)

    made = [column, check] if check else [column]
    kept = [c for c in (docs.columns if carry is None else carry) if c.lower() not in [m.lower() for m in made]]
    names = [*kept, *made]
    # The text goes to the tasks once, and comes back only if it is carried.
    own_text, own_seed = text if text in kept else free_name(docs, "__text"), free_name(docs, "__seed")
    sent = [] if text in kept else [F.col(text).alias(own_text)]
    seeded = docs.select(*kept, *sent, F.xxhash64(F.col(key).cast("string")).alias(own_seed))
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(column, T._parse_datatype_string(SEGMENTATION)),
                           *([T.StructField(check, T.BooleanType())] if check else [])])
    return seeded.mapInArrow(tidy(run), schema)


def decode(samples: DataFrame, ids: str = "ids", column: str = "decoded", model: str = MODEL) -> DataFrame:
    """``samples`` with the text of an array<int> column of piece numbers."""
    raw = samples.sparkSession.sparkContext.broadcast(load_vocabulary(model)["raw"])
    return samples.withColumn(column, F.pandas_udf(
        lambda s: s.map(lambda x: None if x is None else decode_ids(raw.value, x)), "string")(F.col(ids)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), check="round_trip", carry=["doc_id"]).select(
        "doc_id", F.size("samples").alias("n_samples"), "round_trip", "samples")
