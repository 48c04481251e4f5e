"""Double-array tries over word phrases of one length, walked by numpy for many positions at once.

Every word has a number, written in digits to base 256; a phrase is the digits of its
language's number and of its words'. The child of state s for digit d is state base[s] + d,
and it is a child of s only if check[base[s] + d] == s.
"""

from __future__ import annotations

import numpy as np

RADIX_BITS = 8
RADIX = 1 << RADIX_BITS
# Nodes with this many children take a block of their own; the gaps go to others.
DENSE = 64
TRIES_PER_CLASS = 24


def digits_needed(symbols: int) -> int:
    return max(1, -(-int(symbols).bit_length() // RADIX_BITS))


def _placed(parents: np.ndarray, digits: np.ndarray, nodes: int, seed: int) -> tuple[np.ndarray, int]:
    """A base for each of ``nodes`` parents, and the number of slots.

    ``parents`` (in order) and ``digits`` name the children. All parents of a class of sizes
    propose a random base at once; those whose children hit free slots that no earlier one
    claims have theirs. What stays unplaced goes to fresh slots behind.
    """
    rng = np.random.default_rng(seed)
    counts = np.bincount(parents, minlength=nodes).astype(np.int32)
    begin = np.cumsum(counts, dtype=np.int32) - counts
    base = np.zeros(nodes, np.int32)
    dense = np.flatnonzero(counts >= DENSE)
    # The first block stays free: slot 0 is the root, and a single child may sit up to a block
    # above its parent's base.
    size = RADIX * (1 + len(dense)) + int(1.5 * len(digits)) + 2 * RADIX
    used = np.zeros(size, bool)
    used[:RADIX] = True
    base[dense] = RADIX * (1 + np.arange(len(dense)))

    def slots_of(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of these parents: place among ``some``, and child."""
        which = np.repeat(np.arange(len(some)), counts[some])
        inside = np.arange(len(which)) - np.repeat(np.cumsum(counts[some]) - counts[some], counts[some])
        return which, begin[some][which] + inside

    which, child = slots_of(dense)
    used[base[dense][which] + digits[child]] = True
    for least, most in ((16, DENSE), (6, 16), (3, 6), (2, 3)):
        waiting, low, tries = np.flatnonzero((counts >= least) & (counts < most)), RADIX, 0
        while len(waiting):
            if tries and tries % TRIES_PER_CLASS == 0:
                low = len(used) - RADIX
                used = np.concatenate([used, np.zeros(2 * int(counts[waiting].sum()) + 2 * RADIX, bool)])
            tries += 1
            proposed = rng.integers(low, len(used) - RADIX, len(waiting))
            which, child = slots_of(waiting)
            slots = proposed[which] + digits[child]
            claims = np.full(len(used), len(waiting), np.int32)
            np.minimum.at(claims, slots, which.astype(np.int32))
            lost = np.bincount(which[used[slots] | (claims[slots] != which)], minlength=len(waiting)) > 0
            base[waiting[~lost]] = proposed[~lost]
            used[slots[~lost[which]]] = True
            waiting = waiting[lost]
    single = np.flatnonzero(counts == 1)
    free = np.flatnonzero(~used)
    if len(free) < len(single):
        free = np.concatenate([free, np.arange(len(used), len(used) + len(single) - len(free))])
    base[single] = free[: len(single)] - digits[begin[single]]
    last = int((base[parents] + digits).max(initial=0))
    return base, max(last, int(base.max(initial=0))) + RADIX + 1


class DoubleArray:
    """The trie of paths: rows of symbols from 1 up, all of one length, each with an id."""

    def __init__(self, base: np.ndarray, check: np.ndarray, accepting: np.ndarray, ids: np.ndarray, width: int):
        self.base, self.check, self.accepting, self.ids, self.width = base, check, accepting, ids, width

    @classmethod
    def of(cls, paths: np.ndarray, ids: np.ndarray, symbols: int, seed: int = 0) -> DoubleArray:
        """``paths`` (n, length), different rows of numbers from 1 to ``symbols``."""
        width = digits_needed(symbols)
        order = np.lexsort(paths.T[::-1])
        paths, ids = paths[order], ids[order]
        shifts = RADIX_BITS * np.arange(width - 1, -1, -1)
        digits = np.column_stack([((column >> shift) & (RADIX - 1)).astype(np.uint8) for column in paths.T for shift in shifts])
        # Nodes level by level: a new one wherever a row's beginning differs from the row before.
        node, count = np.zeros(len(paths), np.int32), 1
        parents, letters = [], []
        new = np.zeros(len(paths), bool)
        new[:1] = True
        for level in range(digits.shape[1]):
            new[1:] |= digits[1:, level] != digits[:-1, level]
            parents.append(node[new])
            letters.append(digits[new, level])
            node = np.cumsum(new, dtype=np.int32) + np.int32(count - 1)
            count += int(new.sum())
        parents, letters = np.concatenate(parents), np.concatenate(letters).astype(np.int32)
        bases, size = _placed(parents, letters, count, seed)
        state = np.concatenate([np.zeros(1, np.int32), bases[parents] + letters])
        base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        base[state] = bases
        check[state[1:]] = state[parents]
        at = np.argsort(state[node])
        return cls(base, check, state[node][at].astype(np.int32), ids[at], width)

    def step(self, states: np.ndarray, positions: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and positions that are left after reading symbols[positions]."""
        for shift in range(RADIX_BITS * (self.width - 1), -1, -RADIX_BITS):
            slots = self.base[states] + ((symbols[positions] >> shift) & (RADIX - 1))
            known = self.check[slots] == states
            states, positions = slots[known], positions[known]
        return states, positions

    def matches(self, start: int, symbols: np.ndarray, length: int) -> np.ndarray:
        """The accepting state reached from every position where a path below ``start`` reads on.

        Level by level, all positions at once; ``symbols`` has 0 for what no path holds, and
        numbers of at most ``width`` digits."""
        padded = np.append(symbols, np.zeros(length, symbols.dtype))
        positions = np.flatnonzero(symbols)
        states = np.full(len(positions), start, np.int32)
        for level in range(length):
            states, positions = self.step(states, positions, padded[level:])
        return states

    def reached(self, start: int, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The accepting states reached below ``start``, and the rows of ``paths`` (n, length) that
        reach them; level by level, all rows at once. Numbers as in :meth:`matches`."""
        rows = np.flatnonzero(paths.all(axis=1))
        states = np.full(len(rows), start, np.int32)
        for level in range(paths.shape[1]):
            states, rows = self.step(states, rows, paths[:, level])
        return states, rows

    def ids_of(self, states: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.accepting, states)]
