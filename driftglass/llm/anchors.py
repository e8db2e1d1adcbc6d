"""Content anchors: for every window of ``span`` bytes the least ``k``-byte hash in it (leftmost at ties).

Equal windows have equal anchors at equal places, so windows need to be compared only where anchor hashes are equal.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from driftglass.llm.blocks import mix

CHUNK = 1 << 19
PLACE = np.uint64((1 << 24) - 1)
BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random byte values, powers of the base and of its inverse modulo 2^64."""
    letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    up = np.full(n, BASE, np.uint64)
    up[0] = 1
    down = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    return letters, np.cumprod(up), np.cumprod(down)


def gram_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-byte strings of ``raw`` (at most CHUNK bytes)."""
    letters, up, down = _tables(CHUNK)
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[raw] * up[:n], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values, by doubling."""
    have, m = 1, x
    while 2 * have <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(m) - (w - have)], m[w - have :]) if w > have else m


def window_anchors(raw: np.ndarray, ends: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window start, last window start) of every run of windows with one anchor, ascending.

    ``raw`` holds texts one after another, ``ends`` their ends; windows never cross an end.
    """
    found = []
    step = CHUNK - span + 1
    for at in range(0, max(1, len(raw) - span + 1), step):
        part = raw[at : at + CHUNK]
        if len(part) < span:
            break
        h = gram_hashes(part, k)
        key = sliding_min((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), span - k + 1)
        starts = np.arange(at, at + len(key))
        inside = np.searchsorted(ends, starts, side="right")
        fits = starts + span <= ends[np.minimum(inside, len(ends) - 1)]
        place = (key & PLACE).astype(np.int64)
        begins = fits & np.concatenate([[True], (place[1:] != place[:-1]) | ~fits[:-1]])
        stops = fits & np.concatenate([(place[1:] != place[:-1]) | ~fits[1:], [True]])
        first = np.flatnonzero(begins)
        found.append((h[place[first]], first + at, np.flatnonzero(stops) + at))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
