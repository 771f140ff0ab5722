"""Word shingles of whole texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** n modulo 2 ** 64."""
    out = np.full(n + 1, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)      # arrays wrap round silently


_POWER = _powers(1 << 16)


def chunks(texts: list[str | None]) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) bytes of texts, about CHUNK_BYTES at a time."""
    got, size = [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass").lower()
        got.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield got
            got, size = [], 0
    if got:
        yield got


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text). A word is a run of
    bytes other than space and 0x09 to 0x0D; its hash is a polynomial of its
    bytes and length, mixed."""
    raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    size = end - start
    h = np.zeros(len(start), np.uint64)
    if len(start):
        for i in range(int(min(size.max(), 64))):       # the i-th byte of every word that has one
            on = np.flatnonzero(size > i)
            h[on] = h[on] * BASE + (raw[start[on] + i].astype(np.uint64) + np.uint64(1))
        for j in np.flatnonzero(size > 64):             # rare long words
            w = raw[start[j] + 64:end[j]].astype(np.uint64) + np.uint64(1)
            for at in range(0, len(w), 1 << 16):
                part = w[at:at + (1 << 16)]
                h[[j]] = h[[j]] * _POWER[len(part)] + (part * _POWER[:len(part)][::-1]).sum(dtype=np.uint64)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    last = np.cumsum(lengths)                             # position of the separator after each text
    upto = np.searchsorted(start, last, side="left")
    return mix(h + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.diff(np.concatenate([[0], upto]))


def shingle_sets(texts: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles of each text, sorted, one text after the other; their
    number per text). A text of fewer than ``k`` words has its whole sequence as
    one shingle; a text without words has none."""
    h, n = word_hashes(texts)
    total = len(h)
    ends = np.cumsum(n)
    first = ends - n
    out = []
    if total:
        roll = np.zeros(max(0, total - k + 1), np.uint64)
        for i in range(k):
            roll = roll * BASE + h[i:i + len(roll)]
        at = np.arange(len(roll))
        doc = np.searchsorted(ends, at, side="right")
        inside = at + k <= ends[doc]
        out.append((doc[inside], mix(roll[inside])))
        for d in np.flatnonzero((n > 0) & (n < k)):
            x = np.array([n[d]], np.uint64)
            for i in range(first[d], ends[d]):
                x = x * BASE + h[[i]]
            out.append((np.array([d]), mix(x)))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    doc, s = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    return s[new], np.bincount(doc[new], minlength=len(texts))


def digests(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two 64-bit digests of each set (rows of two); equal sets agree, an empty set has zeros."""
    out = np.zeros((len(sizes), 2), np.int64)
    some = np.flatnonzero(sizes > 0)
    if len(some):
        start = (np.cumsum(sizes) - sizes)[some]
        out[some, 0] = np.add.reduceat(mix(sets ^ BASE), start).view(np.int64)
        out[some, 1] = np.bitwise_xor.reduceat(mix(sets + BASE), start).view(np.int64)
    return out


def signatures(sets: np.ndarray, sizes: np.ndarray, coords: int, seed: int = 11) -> np.ndarray:
    """MinHash signatures (one row of ``coords`` 32-bit values per text; empty sets give zeros)."""
    out = np.zeros((len(sizes), coords), np.uint32)
    some = np.flatnonzero(sizes > 0)
    if not len(some):
        return out
    start = (np.cumsum(sizes) - sizes)[some]
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, coords, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 63, coords, dtype=np.uint64)
    for c in range(coords):
        v = ((sets ^ b[c]) * a[c]) >> np.uint64(32)
        out[some, c] = np.minimum.reduceat(v.astype(np.uint32), start)
    return out
