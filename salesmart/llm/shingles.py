"""Word n-gram sets and their MinHash signatures, vectorised over slices of texts.

A word is a maximal run of letters a-z, digits and non-ASCII characters after
lower-casing; case and punctuation don't count. A text's set holds the 64-bit
hashes of its distinct n-grams; one of 1 to n - 1 words has one, of all its
words; one without words has none.
"""

from __future__ import annotations

import math

import numpy as np

from salesmart.llm.common import per_process

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IN_WORD = np.array([chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" or b >= 0x80 for b in range(256)], np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    size = 1 << max(16, (n - 1).bit_length())

    def make() -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)
    return per_process(f"powers {base} {size}", make)[:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of all texts, and each text's first word (and the end)."""
    encoded = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    inside = _IN_WORD[data]
    step = np.diff(inside, prepend=np.uint8(0), append=np.uint8(0)).view(np.int8)
    first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, max(1, len(data)))[:len(data)], out=sums[1:])
    hashes = mixed((sums[end] - sums[first]) * _powers(_INVERSE, len(data) + 1)[first])
    starts = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    return hashes, np.searchsorted(first, starts)


def ngram_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words, edges = word_hashes(texts)
    factors = [np.uint64((0xD6E8FEB86659FD93 * (2 * j + 1) + j) % (1 << 64) | 1) for j in range(n)]
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j, f in enumerate(factors):
        grams += words[j:len(words) - n + 1 + j] * f
    grams = mixed(grams)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            whole = sum((words[a + j:a + j + 1] * factors[j] for j in range(b - a)), np.full(1, b - a, np.uint64))
            out.append(mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def choose_bands(similarity: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows a band - so the fewest false candidates - for which a pair
    at ``similarity`` meets in a band with probability ``recall`` within ``most_hashes``."""
    best = None
    for rows in range(1, most_hashes + 1):
        meet = similarity ** rows
        bands = 1 if meet >= recall else math.ceil(math.log(1 - recall) / math.log(1 - meet))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding within most_hashes reaches the recall")
    return best


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A (texts x bands) array of MinHash band hashes; sets must not be empty."""
    rng = np.random.default_rng(20)
    factors = rng.integers(1, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, bands * rows, np.uint64)
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    out = np.zeros((len(sets), bands), np.uint64)
    for band in range(bands):
        acc = np.full(len(sets), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            acc = mixed(acc ^ np.minimum.reduceat(flat * factors[k] + shifts[k], starts)) + np.uint64(k)
        out[:, band] = acc
    return out
