"""Rolling hashes and winnowed anchors over arrays of symbols (bytes or word hashes).

A *window* is ``window`` consecutive symbols, a *gram* fewer. Every window selects its gram
of smallest hash (the rightmost of equals) as anchor, so equal windows select the same
anchor at the same offset wherever they stand, and consecutive windows mostly share one.
"""

from __future__ import annotations

import numpy as np

_POSITION_BITS = 24
_POSITION = np.uint64((1 << _POSITION_BITS) - 1)
#: Windows handled at once, which bounds the memory for very long texts.
BLOCK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (a finaliser of two multiply-xorshift rounds)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class RollingHash:
    """Polynomial hashes modulo 2^64 of any span of an array, from one prefix sum."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 2 + 1
        self.byte_values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            n = max(n, 2 * len(self._powers))
            for name, base in (("_powers", self.base), ("_inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self._inverse[:n], dtype=np.uint64, out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((prefix[end] - prefix[start]) * self._powers[start])

    def every(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """The hashes of all spans of ``length`` symbols."""
        n = len(prefix) - length
        return mixed((prefix[length:] - prefix[:n]) * self._powers[:n])


#: Two independent hashes; together they name a span by 128 bits.
FIRST, SECOND = RollingHash(11), RollingHash(23)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    n = len(x) - width + 1
    return np.minimum(out[:n], out[width - span:width - span + n])


def anchors(first: np.ndarray, second: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """The anchors of all windows of one text, given as the symbols' values under both hashes.

    ``bucket`` names the anchor's gram; ``lo`` and ``hi`` are the first and last window that
    select it; ``context`` names everything those windows cover and how it lies about the
    anchor: anchors of equal bucket and context stand for the same windows, one by one.
    """
    parts = [_block(first[at:at + BLOCK + window - 1], second[at:at + BLOCK + window - 1], window, gram, at)
             for at in range(0, max(len(first) - window + 1, 0), BLOCK)]
    names = ("bucket", "context", "anchor", "lo", "hi")
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in names}


def _block(first, second, window, gram, at):
    p1 = FIRST.prefix(first)
    grams = FIRST.every(p1, gram)
    ranked = (grams & ~_POSITION) | (_POSITION - np.arange(len(grams), dtype=np.uint64))
    chosen = (_POSITION - (sliding_min(ranked, window - gram + 1) & _POSITION)).astype(np.int64)
    turns = np.flatnonzero(chosen[1:] != chosen[:-1])
    lo = np.concatenate([[0], turns + 1])
    hi = np.concatenate([turns, [len(chosen) - 1]])
    anchor = chosen[lo]
    around = SECOND.spans(SECOND.prefix(second), lo, hi + window)
    shape = ((anchor - lo) * window + (hi - lo)).astype(np.uint64)
    return {"bucket": grams[anchor].view(np.int64), "anchor": anchor + at,
            "context": mixed(around + mixed(shape + np.uint64(1))).view(np.int64), "lo": lo + at, "hi": hi + at}


def cells(first: np.ndarray, second: np.ndarray, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray,
          window: int, width: int) -> dict[str, np.ndarray]:
    """The window intervals cut into cells of ``width`` offsets from their anchors.

    All windows of a cell contain its core, which ``bucket`` names; ``context`` names what
    those of them that are in the interval cover.
    """
    offset = np.arange(0, window, width)
    a, b = np.maximum(lo[:, None], anchor[:, None] - offset - width + 1), np.minimum(hi[:, None], anchor[:, None] - offset)
    item, cell = np.nonzero(a <= b)
    lo, hi, near = a[item, cell], b[item, cell], anchor[item] - offset[cell]
    core = FIRST.spans(FIRST.prefix(first), near, near - width + 1 + window)
    around = SECOND.spans(SECOND.prefix(second), lo, hi + window)
    shape = ((near - lo) * window + (near - hi)).astype(np.uint64)
    return {"bucket": mixed(core + cell.astype(np.uint64)).view(np.int64), "anchor": anchor[item],
            "context": mixed(around + mixed(shape + np.uint64(1))).view(np.int64), "lo": lo, "hi": hi}


def windows(first: np.ndarray, second: np.ndarray, lo: np.ndarray, hi: np.ndarray,
            window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and 128-bit name of every window ``lo[i] .. hi[i]``."""
    counts = hi - lo + 1
    start = np.repeat(lo - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return (start, FIRST.spans(FIRST.prefix(first), start, start + window).view(np.int64),
            SECOND.spans(SECOND.prefix(second), start, start + window).view(np.int64))


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching intervals merged into maximal runs."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]
