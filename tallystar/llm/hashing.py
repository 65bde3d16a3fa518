"""Vectorised word splitting and hashing of UTF-8 text (numpy, inside tasks).

Every function works on whole texts in pieces of a few megabytes, so memory
per task does not grow with the length of a text (only a single word longer
than a piece makes its piece longer). Null counts as the empty text.
"""

from __future__ import annotations

import numpy as np

PIECE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(lower: bool = False) -> np.ndarray:
    """A fixed random 64-bit code per byte; A-Z share the codes of a-z if ``lower``."""
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * BASE)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def class_table(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans, true inside the given inclusive byte ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


# Bytes of a word: everything but space and 0x09-0x0D / only 0-9, A-Z, a-z and non-ASCII.
NOT_BLANK = ~class_table((0x20, 0x20), (0x09, 0x0D))
ALNUM = class_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        n = max(n, 2 * PIECE_BYTES)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", inverse)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def utf8(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else (t or b"") for t in texts]


def text_runs(texts: list[bytes], limit: int = 1 << 21):
    """(start, end) runs of texts of about ``limit`` bytes."""
    at = held = 0
    for k, t in enumerate(texts):
        held += len(t) + 1
        if held >= limit:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def prefix_hash(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of code[data[j]] * BASE**j over j < i."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * up[:len(data)], out=out[1:])
    return out


def prefix_hash_codes(codes: np.ndarray) -> np.ndarray:
    """``prefix_hash`` of a sequence given by its codes."""
    up, _ = powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[:len(codes)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever the bytes stand."""
    _, down = powers(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * BASE)


def _pieces(texts: list[bytes], inside: np.ndarray):
    """(text number, offset, bytes): texts cut at non-word bytes so that no
    piece is much longer than PIECE_BYTES."""
    for k, text in enumerate(texts):
        at = 0
        while len(text) - at > PIECE_BYTES:
            end = at + PIECE_BYTES
            while True:
                gaps = np.flatnonzero(~inside[np.frombuffer(text, np.uint8, min(end, len(text)) - at, at)])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                    break
                if end >= len(text):
                    end = len(text)
                    break
                end += PIECE_BYTES
            yield k, at, text[at:end]
            at = end
        yield k, at, text[at:] if at else text


def _blocks(texts: list[bytes], inside: np.ndarray):
    held, size = [], 0
    for piece in _pieces(texts, inside):
        held.append(piece)
        size += len(piece[2]) + 1
        if size >= PIECE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def words(texts: list[bytes], inside: np.ndarray, codes: np.ndarray):
    """All words of a batch: (hash, text number, start byte, end byte)."""
    found = []
    for block in _blocks(texts, inside):
        data = np.frombuffer(b"\n".join(p[2] for p in block), np.uint8)
        sizes = np.array([len(p[2]) + 1 for p in block], dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside[data], [False]))))
        start, end = edge[0::2], edge[1::2]
        if not len(start):
            continue
        h = range_hash(prefix_hash(data, codes), start, end)
        which = np.searchsorted(first, start, side="right") - 1
        shift = np.array([p[1] for p in block], dtype=np.int64) - first
        found.append((h, np.array([p[0] for p in block], dtype=np.int64)[which],
                      start + shift[which], end + shift[which]))
    if not found:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def chains(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive entries of ``h`` (len(h) - n + 1 of them)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[:len(h) - n + 1].copy()
    for j in range(1, n):
        out = mix64(out * BASE + h[j:len(h) - n + 1 + j])
    return mix64(out + np.uint64(n))
