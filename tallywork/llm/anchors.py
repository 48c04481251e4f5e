"""Content-defined anchors: which runs of a fixed length can repeat, found by rolling hashes.

A sequence (bytes, or words as numbers) is cut at the minima of a rolling hash of ``k``
symbols. Every window of ``length`` symbols is assigned the leftmost smallest ``k``-gram
inside it, so equal windows are assigned equal k-grams at equal offsets, wherever they
lie. Neighbouring windows with the same anchor form a span; a sequence has about
2 / (length - k + 2) spans a symbol.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

INDEX_BITS = 24
MAX_SYMBOLS = 1 << INDEX_BITS
_rng = np.random.default_rng(0x5EED)
# Two odd multipliers for two independent polynomials modulo 2**64, and a number for each byte.
BASES = tuple(int(x) | 1 for x in _rng.integers(1 << 60, 1 << 63, 2))
BYTE_VALUES = _rng.integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[tuple[int, bool], np.ndarray] = {}


class Spans(NamedTuple):
    """Spans of a chunk; positions count symbols of the chunk.

    The windows of a span start at ``first`` to ``last``; ``key`` is the hash of its anchor
    at ``anchor``, ``span`` the hash of all its symbols, ``first`` to ``last + length``.
    """

    key: np.ndarray
    span: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    held = _powers.get((base, inverse))
    if held is None or len(held) < n:
        size = 1 << max(16, (n - 1).bit_length())
        value = pow(base, -1, 1 << 64) if inverse else base
        steps = np.full(size, value, np.uint64)
        steps[0] = 1
        held = _powers[base, inverse] = np.cumprod(steps, dtype=np.uint64)
    return held[:n]


def prefix(symbols: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which :func:`hashed` takes the hash of any range."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(base, len(symbols)), dtype=np.uint64, out=out[1:])
    return out


def hashed(sums: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice, base: int) -> np.ndarray:
    """Hash of symbols start to end: the same wherever these symbols lie."""
    return (sums[end] - sums[start]) * powers(base, len(sums), inverse=True)[start]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def spans(symbols: np.ndarray, ends: np.ndarray, k: int, length: int) -> Spans:
    """Spans of a chunk of sequences laid end to end; none crosses from one to the next.

    ``symbols`` are 64-bit numbers, ``ends`` the positions where the sequences end.
    """
    n = len(symbols)
    if n > MAX_SYMBOLS:
        raise ValueError(f"a chunk holds at most {MAX_SYMBOLS} symbols; cut long sequences with pieces()")
    none = np.zeros(0, np.int64)
    if n < length:
        return Spans(none.view(np.uint64), none.view(np.uint64), none, none, none)
    sums = prefix(symbols, BASES[0])
    grams = mixed(hashed(sums, slice(0, n - k + 1), slice(k, n + 1), BASES[0]))
    # The upper bits order, the position breaks ties towards the left.
    index = np.arange(len(grams), dtype=np.uint64)
    ordered = ((grams >> np.uint64(INDEX_BITS)) << np.uint64(INDEX_BITS)) | index
    least = sliding_min(ordered, length - k + 1)
    room = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)] - np.arange(len(least))
    starts = np.flatnonzero(room >= length)
    if not len(starts):
        return Spans(none.view(np.uint64), none.view(np.uint64), none, none, none)
    anchor = (least[starts] & np.uint64(MAX_SYMBOLS - 1)).astype(np.int64)
    change = np.flatnonzero(np.diff(anchor)) + 1
    opens = np.concatenate([[0], change])
    closes = np.concatenate([change, [len(starts)]]) - 1
    first, last, anchor = starts[opens], starts[closes], anchor[opens]
    sums = prefix(symbols, BASES[1])
    whole = hashed(sums, first, last + length, BASES[1]) + (last - first).astype(np.uint64)
    return Spans(grams[anchor], mixed(whole), first, last, anchor)


def pieces(size: int, length: int, most: int = MAX_SYMBOLS // 2) -> list[tuple[int, int]]:
    """Ranges of a long sequence such that each window of ``length`` lies in one of them,
    and starts in exactly one."""
    if size <= most:
        return [(0, size)]
    return [(at, min(size, at + most + length - 1)) for at in range(0, size, most) if at == 0 or size - at >= length]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word (run of bytes other than white space)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    opens, closes = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = prefix(BYTE_VALUES[data], BASES[0])
    values = hashed(sums, opens, closes, BASES[0]) + (closes - opens).astype(np.uint64)
    return opens, closes, mixed(values)
