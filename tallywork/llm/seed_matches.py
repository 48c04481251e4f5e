"""Seed matches extended both ways, without listing pairs.

All places of a seed lie sorted by the words from it rightwards, so how far a place agrees to the
right with any other is told by its neighbours in that order. To the left the places are
parted a word at a time: those that agree on one more word stay together, the others
leave, and again only neighbours of what stays are compared. So n places take n log n steps
a word of extension, where pairs would take n * n.
"""

from __future__ import annotations

import numpy as np

# Places that one step sorts; a seed has at most repeats.SEED_PLACES of them.
STEP = 1 << 14


class _Least:
    """The least of any run of numbers, from the least of runs of 1, 2, 4, ... of them."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            have, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(have[:-half], have[half:]))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of values low to high - 1; every run has one value or more."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for number in np.unique(level):
            at = np.flatnonzero(level == number)
            values = self.levels[number]
            out[at] = np.minimum(values[low[at]], values[high[at] - (1 << int(number))])
        return out


def _step(
    key: np.ndarray, words: np.ndarray, seed: np.ndarray, before: np.ndarray, after: np.ndarray, k: int, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    reach = length - k
    right = np.arange(length)
    right = np.where(right < after[:, None], words[np.minimum(seed[:, None] + right, len(words) - 1)], 0)
    rows = np.concatenate([key[:, None], right], axis=1)
    order = np.argsort(rows.view(f"S{8 * rows.shape[1]}").ravel(), kind="stable")
    seed, before, after, rows = seed[order], before[order], after[order], rows[order]
    # Words from the seed on that a place shares with the one above it; less than the seed is no match.
    same = np.concatenate([rows[1:] == rows[:-1], np.zeros((max(len(rows) - 1, 0), 1), bool)], axis=1)
    shared = np.maximum(same.argmin(axis=1) - 1, 0) if len(same) else np.zeros(0, np.int64)
    shared = np.minimum(shared, np.minimum(after[1:], after[:-1]))
    shared[shared < k] = 0
    least = _Least(np.concatenate([[0], shared]))
    stay, group = np.arange(len(order)), np.cumsum(np.concatenate([[0], shared == 0]))
    found = []
    for left in range(reach + 1):
        if left:
            keep = before[stay] >= left
            stay, group = stay[keep], group[keep]
            word = words[seed[stay] - left]
            by = np.lexsort((stay, word, group))
            stay, group, word = stay[by], group[by], word[by]
            change = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
            group = np.cumsum(np.concatenate([[0], change]))[: len(stay)]
        together = group[1:] == group[:-1]
        companion = np.concatenate([[False], together])[: len(stay)] | np.concatenate([together, [False]])[: len(stay)]
        stay, group = stay[companion], group[companion]
        if not len(stay):
            break
        together = group[1:] == group[:-1]
        agree = np.zeros(len(stay) - 1, np.int64)
        agree[together] = least.of(stay[:-1][together] + 1, stay[1:][together] + 1)
        best = np.maximum(np.concatenate([[0], agree]), np.concatenate([agree, [0]]))
        long = best + left >= length
        found.append((order[stay[long]], np.full(int(long.sum()), left), best[long]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def extended(
    key: np.ndarray, words: np.ndarray, start: np.ndarray, size: np.ndarray, offset: np.ndarray, k: int, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every place of a seed extended as far as the words around it agree with another place.

    Place i has the seed ``key[i]`` of ``k`` words at ``offset[i]`` of the ``size[i]`` words that
    begin at ``words[start[i]]``. Returns (place, words left of the seed, words from the seed's
    start on) of each match of ``length`` words or more that cannot be made longer to the
    right; to the left there is one for each number of words. No place matches itself. ``words``
    are 64-bit numbers, compared whole; at most ``length - k`` words each side of the seed count.
    """
    by = np.argsort(key, kind="stable")
    turn = np.flatnonzero(np.concatenate([[True], np.diff(key[by]) != 0])) if len(by) else by
    step = np.searchsorted(turn, np.arange(0, len(by), STEP))
    bounds = np.unique(np.concatenate([turn[step[step < len(turn)]], [len(by)]]).astype(np.int64))
    found = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        some = by[low:high]
        place, left, right = _step(
            key[some].view(np.uint64), words, start[some] + offset[some], offset[some], size[some] - offset[some], k, length
        )
        found.append((some[place], left, right))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))
