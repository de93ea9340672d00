"""Word n-gram sets and their MinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np

_STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_POWERS: list[np.ndarray] = []
#: Texts are hashed in stretches of at most so many words.
STRETCH = 1 << 14


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, up to at least ``n``."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 12, 1 << n.bit_length())
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size, s, np.uint64)], dtype=np.uint64)
                      for s in (_STEP, pow(_STEP, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of ``data``."""
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ngram_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams: lower case, words
    split at ASCII white space.  A text of fewer than ``n`` words has one
    gram of all its words; a text without words (or NULL) has none."""
    words = (text or "").lower().encode("utf-8", "replace").split()
    if not words:
        return np.empty(0, np.uint64)
    out = []
    for at in range(0, max(1, len(words) - n + 1), STRETCH):
        some = words[at: at + STRETCH + n - 1]
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        k = max(1, len(some) - n + 1)
        last = min(n, len(some)) - 1
        out.append(span_hashes(np.frombuffer(b" ".join(some), np.uint8), starts[:k], ends[last: last + k]))
    return np.unique(np.concatenate(out) if len(out) > 1 else out[0])


def min_hashes(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The MinHash of ``grams`` under each permutation a * x + b."""
    high = (grams >> np.uint64(32)).astype(np.uint32)
    sig = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 1024):
        np.minimum(sig, (a[:, None] * high[None, at: at + 1024] + b[:, None]).min(axis=1), out=sig)
    return sig
