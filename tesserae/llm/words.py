"""Words, lines and their hashes over a whole buffer of texts, in numpy.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D. A hash is 64 bits: a polynomial over random
values of the bytes, mixed.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the bytes, powers of an odd base and of its inverse, for n bytes at least."""
    if seed not in _powers or len(_powers[seed][1]) < n:
        base = (int(mix(np.array([seed * 2 + 1], np.uint64))[0]) | 1) & (2**64 - 1)
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            ups, downs = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (base, pow(base, -1, 2**64)))
            _powers[seed] = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD + np.uint64(seed)), ups, downs
    return _powers[seed]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def buffer_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of one buffer."""
    inside = np.zeros(len(data) + 2, bool)
    np.take(~_SPACE, data, out=inside[1:-1])
    at = np.flatnonzero(inside[1:] != inside[:-1])
    return at[::2], at[1::2]


def quick_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: bool = False) -> np.ndarray:
    """The hash of data[s:e] for each span that is not empty, eight bytes at a time; or another such hash. Spans of up to eight bytes and one length never share one."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first, step, shift = (_M2, _GOLD, np.uint64(27)) if other else (_GOLD, _M1, np.uint64(31))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))  # from each byte on
    n = ends - starts
    size = n.astype(np.uint64)

    def part(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return eight[at] & (np.uint64(2**64 - 1) >> (np.uint64(8) * (np.uint64(8) - np.minimum(left, np.uint64(8)))))

    h = part(starts, size) * first + size
    h ^= h >> np.uint64(29)
    live, done = np.flatnonzero(n > 8), 8
    while len(live):
        x = (h[live] ^ part(starts[live] + done, size[live] - np.uint64(done))) * step
        h[live] = x ^ (x >> shift)
        done += 8
        live = live[n[live] > done]
    return mix(h)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """The hash of data[s:e] for each span."""
    values, ups, downs = _tables(len(data) + 1, seed)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * ups[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * downs[starts] + (ends - starts).astype(np.uint64) * _GOLD)


def joined(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """The hash of two hashes, in their order."""
    return mix(left * _M1 + (right ^ (right >> np.uint64(29))) * _GOLD + np.uint64(salt))
