"""Vectorised word and shingle hashing of a batch of UTF-8 texts, shared by the near-duplicate operators.

A word is a run of bytes that are neither a space nor one of tab..carriage return; only A-Z are lower-cased, so
lower-casing never changes a length.  A word's hash is a keyed polynomial over its bytes modulo 2**64 with a final
mix, a shingle's hash mixes its words' hashes in order.  Hashes depend on the text alone (fixed key), so they agree on
all executors.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_rng = np.random.default_rng(0x5EED)
#: One random odd value for each byte; A-Z share those of a-z.
BYTE_KEY = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
BYTE_KEY[65:91] = BYTE_KEY[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_BLOCK = 1 << 17  # bytes hashed at a time


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=_U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


_POW = _powers(1 << 12)


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the first byte of every word, in order."""
    b = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[b], prepend=True, append=True))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, _U), start
    size = end - start
    longest = int(size.max())
    pow_ = _POW if longest <= len(_POW) else _powers(longest)
    # only bytes of words are hashed: each byte's offset in its word, then a sum for each word
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    inside = b[~_SPACE[b]]
    offset = np.arange(len(inside)) - np.repeat(first, size)
    return mix(np.add.reduceat(BYTE_KEY[inside] * pow_[offset], first) + _U(0xA5A5) * size.astype(_U)), start


def word_hashes(data: bytes) -> np.ndarray:
    """The hash of every word of the text, in order."""
    return _words(data)[0]


def _rolled(words: np.ndarray, k: int) -> np.ndarray:
    out = np.full(max(0, len(words) - k + 1), _U(k), dtype=_U)
    for i in range(k):
        out = mix(out * _U(0x100000001B3) + words[i : len(words) - k + 1 + i])
    return out


def shingle_sets(texts: list[bytes | None], k: int):
    """Yields the sorted distinct hashes of each text's k-word shingles, as many texts at once as fit in a block.

    A text of fewer than k words has its whole sequence as its one shingle; one without words, or null, has none.
    """
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop] or b"") < _BLOCK):
            size += len(texts[stop] or b"") + 1
            stop += 1
        part = [t or b"" for t in texts[at:stop]]
        hashes, start = _words(b"\n".join(part))
        rolled = _rolled(hashes, k)
        begins = np.cumsum([0] + [len(t) + 1 for t in part])
        cut = np.searchsorted(start, begins)
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            if e - s >= k:
                out = np.sort(rolled[s : e - k + 1])
                yield out[np.concatenate(([True], out[1:] != out[:-1]))]
            else:
                yield _rolled(hashes[s:e], e - s) if e > s else np.empty(0, _U)
        at = stop
