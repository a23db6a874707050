"""Word shingles of many texts at once, as sets of 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE, _WRAP = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Bytes of text that are hashed together.
BLOCK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, 2**bits of them."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.ones(1, np.uint64)
        for _ in range(bits):
            p = np.concatenate([p, p * np.uint64(b)])
            b = b * b & _WRAP
        out.append(p)
    return out[0], out[1]


def _block(raw: bytes, ends: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of one block; ends: where each text ends in it."""
    a = np.frombuffer(raw, np.uint8)
    word = ~_SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    # each byte is mixed with its place in the word before they are summed: sums of powers modulo 2**64 have words that meet by construction
    place = np.arange(len(a)) - np.repeat(np.concatenate([[0], start]), np.diff(np.concatenate([[0], start, [len(a)]])))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed((place.astype(np.uint64) << np.uint64(8)) + a + np.uint64(1)))])
    words = mixed(total[end] - total[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    first = np.searchsorted(start, np.concatenate([[0], ends[:-1]]))
    last = np.searchsorted(start, ends)
    grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        grams = grams * np.uint64(_BASE) + words[k : k + len(grams)]
    grams = mixed(grams + np.uint64(width))
    out = []
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        if j - i >= width:
            g = np.sort(grams[i : j - width + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif j > i:
            h = np.uint64(0)
            for w in words[i:j]:
                h = (h * np.uint64(_BASE) & np.uint64(_WRAP)) + w
            out.append(mixed(np.array([h + np.uint64(j - i)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles.

    Words are runs of non-blanks after lower-casing A-Z. A text with fewer
    words than ``width`` has its whole word sequence as one shingle; one
    without words, or null, has none.
    """
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0
    with np.errstate(over="ignore"):
        for t in texts:
            held.append(b"" if t is None else t.encode().lower())
            size += len(held[-1]) + 1
            if size >= BLOCK:
                out += _block(b" ".join(held), np.cumsum([len(x) + 1 for x in held]), width)
                held, size = [], 0
        if held:
            out += _block(b" ".join(held), np.cumsum([len(x) + 1 for x in held]), width)
    return out
