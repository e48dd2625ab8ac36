"""Repeated windows of a few texts, by threshold-bounded interval expansion.

The texts are joined with separators and their suffixes sorted as far as the
window length needs, which gives the Burrows-Wheeler transform. Starting from the
interval of all suffixes, intervals are extended backward by one character at a
time, breadth first: an interval of a string of length l + 1 that ends at a border
no shorter string ended at shows that the common prefix at that border has length
l. Borders thus receive their common prefix by increasing value, and after
``length`` rounds those without one are exactly the borders whose common prefix
is at least ``length``. All steps work on whole arrays.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by prefix
    doubling; only suffixes that are still tied are sorted again."""
    n = len(symbols)
    key = symbols.astype(np.int64)
    for shift in (1, 2):  # four symbols of nine bits
        key[: n - shift] = (key[: n - shift] << (9 * shift)) | key[shift:]
        key[n - shift :] <<= 9 * shift
    order = np.argsort(key, kind="stable")
    place = np.arange(n)
    new = np.ones(n, dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    known = 4
    tied = place
    while known < depth:
        run = np.append(np.flatnonzero(new), len(new))
        single = np.repeat(np.diff(run) == 1, np.diff(run))
        tied = tied[~single]  # places in the order whose suffix is not alone in its rank
        if not len(tied):
            break
        suffix = order[tied]
        next_rank = np.where(suffix + known < n, rank[np.minimum(suffix + known, n - 1)], -1)
        key = rank[suffix] * (n + 1) + next_rank + 1
        by = np.argsort(key, kind="stable")
        key, suffix = key[by], suffix[by]
        order[tied] = suffix
        new = np.ones(len(tied), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank[suffix] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        known *= 2
    return order


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places in [low, high) and the number of the range of each."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(len(owner)), owner


def long_borders(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Borders y (between places y - 1 and y of the order) whose common prefix was
    not found within ``length`` rounds. Zero symbols separate texts and are never
    extended over."""
    n = len(symbols)
    last = symbols[order - 1]  # the transform; the first suffix wraps to the last separator
    back = np.empty(n, dtype=np.int64)
    back[np.argsort(last, kind="stable")] = np.arange(n)
    found = np.zeros(n + 1, dtype=bool)
    found[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        at, owner = _ranges(low, high)
        real = last[at] > 0
        at, owner = at[real], owner[real]
        to = back[at]
        by = np.argsort(to, kind="stable")
        to, owner, symbol = to[by], owner[by], last[at[by]]
        if not len(to):
            break
        cut = np.flatnonzero((owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])) + 1
        low, high = to[np.append(0, cut)], to[np.append(cut - 1, len(to) - 1)] + 1
        fresh = ~found[high]
        low, high = low[fresh], high[fresh]
        found[high] = True
    return np.flatnonzero(~found)


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, the starts of its windows of ``length`` bytes that start
    anywhere else as well, in the same text or another."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    total = int(sizes.sum()) + len(texts)
    if total == 0:
        return []
    ends = np.cumsum(sizes + 1) - 1  # places of the separators
    symbols = np.zeros(total, dtype=np.int16)
    inside = np.ones(total, dtype=bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int16) + 1
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    whole = np.arange(total) + length <= ends[owner]
    order = suffix_order(symbols, length)
    border = long_borders(symbols, order, length)
    border = border[whole[order[border - 1]] & whole[order[border]]]
    starts = np.unique(np.concatenate([order[border - 1], order[border]]))
    relative = starts - (ends - sizes)[owner[starts]]
    return np.split(relative, np.searchsorted(starts, (ends - sizes)[1:]))
