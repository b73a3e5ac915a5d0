"""64-bit hashes of words and word runs, for many texts at a time.

A word is a run of ASCII letters and digits and of bytes above 127, lower-cased, so
punctuation and white space never matter. Everything is a function of the words
alone: equal words have equal hashes in every text, task and run.
"""

from __future__ import annotations

import functools

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
#: The inverse of BASE modulo 2^64.
UNBASE = U(pow(int(BASE), -1, 1 << 64))
#: Bytes hashed at a time, whatever the length of the texts.
SEGMENT = 1 << 21

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[65:91] = _WORD[128:] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, BASE), np.full(n + 1, UNBASE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to at least n."""
    return _powers(max(SEGMENT * 2, 1 << n.bit_length()))


def sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of ``(byte + 1) * BASE**i``; a range's sum times BASE**-start depends on its bytes alone."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[:len(data)], out=out[1:])
    return out


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in ``data``, in segments that end between words."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data) and _WORD[data[end - 1]] and _WORD[data[end]]:
            gap = np.flatnonzero(~_WORD[data[end:end + 4096]])
            end = end + int(gap[0]) if len(gap) else min(len(data), end + 4096)
        seg = data[at:end]
        edge = np.diff(_WORD[seg].view(np.int8), prepend=0, append=0)
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        s = sums(seg)
        hashes.append(mix((s[b] - s[a]) * powers(len(seg))[1][a]))
        starts.append(a + at)
        at = end
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.zeros(0, np.int64), np.zeros(0, U))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words begin (one more entry than texts)."""
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b" ".join(parts), np.uint8)
    starts, hashes = _hash_words(data)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    return hashes, np.searchsorted(starts, first)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of ``size`` words in a row of one text; of all its words if it has fewer."""
    size = min(size, len(hashes))
    if not size:
        return np.zeros(0, U)
    n = len(hashes) - size + 1
    h = np.full(n, U(size))
    for i in range(size):
        h = h * BASE + hashes[i:i + n]
    return np.unique(mix(h))
