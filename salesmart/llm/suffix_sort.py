"""Suffix sort by prefix hashes: mergesort whose comparisons find common extensions by binary search.

All of it works on arrays: one level of the mergesort merges all pairs of runs of
all groups at once, and every element finds its place in the run beside its own
by binary search. A comparison halves the length in question until the longest
common extension of two suffixes is known, comparing polynomial hashes, and
then looks at the bytes behind it. Hashes may collide, so neighbours in the
result are compared byte by byte; a group found out of order is sorted by its bytes.
"""

from __future__ import annotations

import numpy as np

from salesmart.llm.common import per_process

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all 64 bits."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BASE = 0x9E3779B97F4A7C15
#: What each byte stands for in the polynomial.
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0xBF58476D1CE4E5B9)) | _U(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64, kept by the worker."""
    cache = per_process("suffix-powers", dict)
    if len(cache.get("p", ())) < n:
        size = max(n, 1 << 18)
        for name, base in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            cache[name] = np.cumprod(x)
    return cache["p"], cache["q"]


class PrefixHashes:
    """Polynomial hashes (modulo 2^64) of all stretches of ``raw``. ``bits``: keep so many (tests)."""

    def __init__(self, raw: np.ndarray, bits: int = 64):
        p, self.back = _powers(len(raw))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LETTERS[raw] * p[:len(raw)], out=self.sums[1:])
        self.mask = _U((1 << bits) - 1)

    def of(self, at: np.ndarray, size) -> np.ndarray:
        """Hash of each stretch of ``size`` bytes that starts at ``at``."""
        return (self.sums[at + size] - self.sums[at]) * self.back[at] & self.mask


def words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes at every place as one number that sorts like them."""
    return np.ndarray((max(len(raw) - 7, 0),), ">u8", np.ascontiguousarray(raw), strides=(1,))


def differ(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """-1, 0 or 1: how the ``size`` (8 at least) bytes at ``a`` compare with those at ``b``."""
    view, out = words(raw), np.zeros(len(a), np.int8)
    todo = np.arange(len(a))
    step = 0
    while len(todo):
        here = np.minimum(step, size[todo] - 8)
        x, y = view[a[todo] + here].astype(np.uint64), view[b[todo] + here].astype(np.uint64)
        out[todo] = np.where(x == y, 0, np.where(x < y, -1, 1))
        step += 8
        todo = todo[(x == y) & (step < size[todo])]
    return out


def _below(raw: np.ndarray, hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, size: int, or_equal: np.ndarray) -> np.ndarray:
    """Whether the suffix at ``a`` sorts before the one at ``b`` (or equal to it, where that counts)."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), size)
    for _ in range(size.bit_length()):
        mid = (low + high + 1) >> 1
        same = hashes.of(a, mid) == hashes.of(b, mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    at = np.minimum(low, size - 1)
    return np.where(low == size, or_equal, raw[a + at] < raw[b + at])


def suffix_sort(raw: np.ndarray, hashes: PrefixHashes, at: np.ndarray, group: np.ndarray,
                size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes ``at`` by (group, first ``size`` bytes), and whether each in that
    order equals the one before it. ``group`` must be sorted; suffixes hold ``size`` bytes."""
    n = len(at)
    order = np.arange(n)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    held = np.diff(np.append(first, n))
    begin, end = np.repeat(first, held), np.repeat(first + held, held)
    place = np.arange(n) - begin
    run, widest, broken = 1, int(held.max()) if n else 0, np.zeros(n, bool)
    while run < widest:
        todo = np.flatnonzero(end - begin > run)
        b, e, p = begin[todo], end[todo], place[todo]
        mine = p // run
        low = np.minimum(b + (mine ^ 1) * run, e)
        high = np.minimum(low + run, e)
        left = low.copy()
        me, right = at[order[todo]], (mine & 1).astype(bool)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) >> 1
            # A left element passes what is smaller, a right one also what is equal: the sort is stable.
            passes = _below(raw, hashes, at[order[mid]], me[open_], size, right[open_])
            low[open_], high[open_] = np.where(passes, mid + 1, low[open_]), np.where(passes, high[open_], mid)
        into = b + (mine >> 1) * (2 * run) + p % run + (low - left)
        merged = order.copy()
        merged[into] = order[todo]
        twice = np.bincount(into, minlength=n) > 1
        if twice.any():  # hashes that collided gave two elements one place
            lost = np.isin(begin, begin[twice])
            merged[lost], broken[lost] = order[lost], True
        order = merged
        run *= 2
    if n < 2:
        return order, np.zeros(n, bool)
    sign = lambda o: differ(raw, at[o[:-1]], at[o[1:]], np.full(n - 1, size))
    together = group[1:] == group[:-1]
    found = sign(order)
    wrong = together & (found > 0) | broken[1:]
    if wrong.any():  # hashes that collided: sort those groups by their bytes
        for g in np.unique(begin[1:][wrong]).tolist():
            part = slice(g, int(end[g]))
            order[part] = sorted(order[part].tolist(), key=lambda i: raw[at[i]:at[i] + size].tobytes())
        found = sign(order)
    return order, np.concatenate([[False], together & (found == 0)])
