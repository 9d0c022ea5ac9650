"""Hashes of all words of a text at once, by array operations on its bytes.

A word is a run of bytes other than the six ASCII white-space characters, ASCII letters lower-cased. Its hash
is a polynomial in its bytes modulo 2^64, taken from running sums over the text, then mixed.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


_UP, _DOWN = _powers(_BASE, SEGMENT), _powers(pow(_BASE, -1, 1 << 64), SEGMENT)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segments(space: np.ndarray):
    """Ranges of about ``SEGMENT`` bytes that end at white space, or the end."""
    begin, n = 0, len(space)
    while begin < n:
        end = min(begin + SEGMENT, n)
        if end < n:
            inside = np.flatnonzero(space[begin:end])
            if len(inside):
                end = begin + int(inside[-1]) + 1
            else:  # one word longer than a segment
                behind = np.flatnonzero(space[end:])
                end = end + int(behind[0]) + 1 if len(behind) else n
        yield begin, end
        begin = end


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word, in order."""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    hashes, begins = [], []
    for low, high in _segments(space):
        gap = np.concatenate([[True], space[low:high], [True]])
        first = np.flatnonzero(gap[:-1] & ~gap[1:])
        last = np.flatnonzero(~gap[:-1] & gap[1:])
        n = high - low
        up, down = (_UP, _DOWN) if n <= SEGMENT else (_powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[raw[low:high]] * up[:n], dtype=np.uint64)])
        hashes.append(mixed((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)))
        begins.append(first + low)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(begins)
