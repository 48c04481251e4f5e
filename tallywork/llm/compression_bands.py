"""Quality rules: zstandard compression bands.

A text that compresses far better than prose of its length repeats itself; one that
hardly compresses is noise, encoded data or keys. How well prose compresses depends on
its length, so each length has a band of its own. The whole text is judged, and so is
every chunk of a fixed size, which finds a repetitive or random part of a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.text import slices

SYMBOLS = "#*$%&|<>"
WINDOW = 8


class Band(NamedTuple):
    """Texts of fewer than ``below`` bytes (None: any) keep lowest <= ratio <= highest.

    The ratio is the number of bytes before compression over that after it.
    """

    below: int | None
    lowest: float
    highest: float


class Limits(NamedTuple):
    """The method's limits; the defaults are those of the registered query.

    Short texts carry the frame's fixed cost and little context, so the lower bound
    starts at 256 bytes; prose of 256 bytes to 100 KB has ratios from 1.3 to 3.
    """

    bands: tuple[Band, ...] = (
        Band(256, 0.0, 3.0),
        Band(1024, 1.15, 3.5),
        Band(4096, 1.4, 4.5),
        Band(16384, 1.6, 5.5),
        Band(None, 1.6, 7.0),
    )
    chunk_bytes: int = 4096
    max_bad_chunk_share: float = 0.3
    level: int = 3


SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_bytes bigint, ratio double, "
    "bad_chunk_share double, reason string"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` (a power of two) words found twice or more.

    Exact: windows are named by doubling (pairs, pairs of pairs, ...), not hashed.
    """
    n = len(words)
    if n <= window:
        return 0
    first: dict[bytes, int] = {}
    names = np.fromiter((first.setdefault(w, len(first)) for w in words), np.int64, n)
    width = 1
    while width < window:
        pairs = names[:-width] * n + names[width:]
        width *= 2
        if width < window:
            distinct, names = np.unique(pairs, return_inverse=True)
        else:
            distinct, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(distinct) == len(pairs):
            return 0
    starts = np.flatnonzero(counts[names] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def base_measures(text: str, raw: bytes) -> tuple[int, int, int, int, int, bool]:
    words = raw.split()
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeats = repeated_words(words)
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        len(words) < 20 or 100 * repeats > 30 * len(words),
    )


class Judge:
    """Compression verdicts under one set of limits."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.compress = zstandard.ZstdCompressor(level=limits.level, write_checksum=False).compress

    def outside(self, size: int, ratio: float) -> str | None:
        band = next(b for b in self.limits.bands if b.below is None or size < b.below)
        return "incompressible" if ratio < band.lowest else "repetitive" if ratio > band.highest else None

    def verdict(self, raw: bytes) -> tuple[float, float, str | None]:
        """Ratio of the whole, share of the bytes in chunks outside their band, reason."""
        if not raw:
            return 0.0, 0.0, None
        ratio = len(raw) / len(self.compress(raw))
        step, bad = self.limits.chunk_bytes, 0
        if len(raw) > step:
            for at in range(0, len(raw), step):
                chunk = raw[at : at + step]
                bad += len(chunk) if self.outside(len(chunk), len(chunk) / len(self.compress(chunk))) else 0
        share = bad / len(raw)
        reason = self.outside(len(raw), ratio)
        if reason is None and share > self.limits.max_bad_chunk_share:
            reason = "bad chunks"
        return ratio, share, reason


def compression_bands(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """One row per row of ``docs``: base measures, compression measures and the verdict.

    ``kept`` is false where the base rules fail (fewer than 20 words, or over 30 % of the
    words in repeated 8-word windows), else it says whether the text and its chunks stay
    inside their bands; ``reason`` names what failed. A null or empty text has no words,
    ratio 0 and fails the base rules. Repeated rows and null ids give a row each; other
    columns are not read. Rows are judged alone: no shuffle, any partitioning.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(limits)
        for batch in slices(batches):
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                value = value or ""
                raw = value.encode()
                base = base_measures(value, raw)
                ratio, share, reason = judge.verdict(raw)
                reason = "base" if base[-1] else reason
                rows.append((key, *base, reason is None, len(raw), ratio, share, reason))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], names=NAMES
            )

    picked = docs.select(F.col(id).cast("bigint"), F.col(text).cast("string"))
    return picked.mapInArrow(judged, SCHEMA)


NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
TYPES = [
    {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}[p.split()[1]]
    for p in SCHEMA.split(", ")
]
