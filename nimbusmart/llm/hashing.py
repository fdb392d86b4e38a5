"""Vectorised hashing of words, word n-grams and MinHash signatures (numpy).

These are the small helpers that run inside Spark tasks. A word is a maximal
run of bytes other than space and \\x09-\\x0D, which on UTF-8 is the same as the
code-point pattern ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_U = np.uint64
# Odd 64-bit multipliers and their inverses modulo 2**64.
_WORD = 0x9E3779B97F4A7C15
_GRAM = 0xD6E8FEB86659FD93
_GRAM_ALT = 0xA0761D6478BD642F
SLICE_BYTES = 1 << 20
# A sum of powers modulo 2^64 tells short words apart; of long ones there are
# families with equal sums for every multiplier, so they get a hash of another kind.
LONG_WORD = 32

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of a multiplier and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=_U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        return self.up, self.down


_WORD_POWERS, _GRAM_POWERS, _ALT_POWERS = _Powers(_WORD), _Powers(_GRAM), _Powers(_GRAM_ALT)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(29))
    h = h * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _word_slices(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about SLICE_BYTES that never split a word."""
    lo, n = 0, len(buf)
    while lo < n:
        hi = min(n, lo + SLICE_BYTES)
        while hi < n and not _SPACE[buf[hi - 1]]:
            nxt = np.flatnonzero(_SPACE[buf[hi : hi + SLICE_BYTES]])
            hi = hi + int(nxt[0]) + 1 if len(nxt) else min(n, hi + SLICE_BYTES)
        yield lo, hi
        lo = hi


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``text`` and the byte offset of each word."""
    buf = np.frombuffer(text, dtype=np.uint8)
    hashes, starts = [], []
    for lo, hi in _word_slices(buf):
        part = buf[lo:hi]
        gap = np.ones(len(part) + 2, dtype=bool)
        gap[1:-1] = _SPACE[part]
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        begin, end = edge[0::2], edge[1::2]
        if not len(begin):
            continue
        up, down = _WORD_POWERS.get(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=_U)
        np.cumsum((part.astype(_U) + _U(1)) * up[: len(part)], out=sums[1:])
        found = mix((sums[end] - sums[begin]) * down[begin])
        for i in np.flatnonzero(end - begin >= LONG_WORD).tolist():
            found[i] = xxhash.xxh3_64_intdigest(text[lo + begin[i] : lo + end[i]])
        hashes.append(found)
        starts.append(begin + lo)
    if not hashes:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def batch_word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of many texts, concatenated, and the offsets of each text's words
    (``offsets[i]:offsets[i + 1]`` are those of text i)."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    hashes, starts = word_hashes(b" ".join(texts) + b" " if texts else b"")
    return hashes, np.searchsorted(starts, first)


def ngram_hashes(words: np.ndarray, n: int, alternative: bool = False) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words (order matters)."""
    if len(words) < n:
        return np.zeros(0, dtype=_U)
    up, down = (_ALT_POWERS if alternative else _GRAM_POWERS).get(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=_U)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; with fewer words the whole
    sequence counts as one shingle, without words the set is empty."""
    if not len(words):
        return np.zeros(0, dtype=_U)
    return np.unique(ngram_hashes(words, min(n, len(words))))


def minhash_multipliers(k: int, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, size=k, dtype=np.uint64) * _U(2) + _U(1)


def minhash(shingles: np.ndarray, multipliers: np.ndarray, step: int = 4096) -> np.ndarray:
    """k minima (32 bits each) over a non-empty shingle set."""
    out = np.full(len(multipliers), np.iinfo(np.uint64).max, dtype=_U)
    for lo in range(0, len(shingles), step):
        np.minimum(out, (shingles[None, lo : lo + step] * multipliers[:, None]).min(axis=1), out=out)
    return (out >> _U(32)).astype(np.uint32)
