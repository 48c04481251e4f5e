"""Packing token sequences: dominance reduction, then best fit.

Lengths are integers up to the capacity, so a packing problem of any size is a histogram of
at most ``capacity`` counts, and one step of the packer deals with all equal cases at once.

The Martello-Toth reduction comes first. For the longest piece left it looks for one, two or
three pieces, itself among them, that dominate every other way to fill its sequence: the
others could be swapped against pieces put elsewhere without a sequence more. Such a set is
fixed for good, as often as its lengths are there, and the instance shrinks. What no small
set dominates is packed by decreasing length, each piece into the fullest sequence with room.

The result is a plan: for each length, ranges of pieces and where they go. Spark numbers
the pieces of each length and looks every piece up in the plan.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywork.functions.running import numbered
from tallywork.llm.text import small_pieces
from tallywork.session import written

CAPACITY, END = 2048, 0
MODEL = "byte_bpe_50k.json"
# The same vocabulary, as ranks.
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"


class Tokens:
    """Token ids as the ``tokenizers`` library gives them, without added special tokens.

    Texts of Latin letters and common punctuation, whose character classes no Unicode
    version changes, are cut by the faster library with the same vocabulary and pattern;
    any other text by ``tokenizers`` itself.
    """

    PLAIN = re.compile("[\x00-ɏ‐-‧€]*")

    def __init__(self, model: str, ranks: str):
        self.any = Tokenizer.from_file(model)
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known,
            special_tokens={SPECIAL: self.any.token_to_id(SPECIAL)},
        )

    def __call__(self, text: str) -> np.ndarray:
        if self.PLAIN.fullmatch(text):
            return self.plain.encode_to_numpy(text, allowed_special="all")
        return np.array(self.any.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than the capacity."""
    first = length % capacity if length > capacity else length
    begin = [(0, first)] if first else []
    return begin + [(at, capacity) for at in range(first, length, capacity)]


# Reduction -----------------------------------------------------------------------------------


def dominating(counts: np.ndarray, longest: int) -> tuple[int, ...] | None:
    """Up to two lengths that, beside a piece of length ``longest``, dominate all other
    fillings of its sequence; None where no such set is found.

    ``counts[n]`` pieces of length n are left, the piece itself among them; its last index is
    the capacity. A set dominates a filling whose pieces can be dealt to pieces of the set
    that are at least as long as all dealt to them together.
    """
    room = len(counts) - 1 - longest
    left = counts[: room + 1].copy()
    if longest <= room:
        left[longest] -= 1
    lengths = np.flatnonzero(left)
    if not len(lengths):
        return ()
    largest = int(lengths[-1])
    if largest == room:
        return (largest,)
    least = np.repeat(lengths[:3], np.minimum(left[lengths[:3]], 3))[:3]
    if len(least) < 2 or least[0] + least[1] > room:
        return (largest,)
    if len(least) == 3 and least.sum() <= room:
        return None
    # At most two others fit. Pairs (x >= y) are dealt to the largest, or y to the second.
    left[largest] -= 1
    fitting = np.flatnonzero(left[: room - largest + 1])
    second = int(fitting[-1]) if len(fitting) else 0
    left[largest] += 1
    for y in lengths[lengths > second]:
        x = lengths[(lengths >= y) & (lengths <= room - y) & (lengths + y > largest)]
        if len(x) > 1 or (len(x) == 1 and (x[0] != y or left[y] > 1)):
            return None
    return (largest, second) if second else (largest,)


Sets = list[tuple[tuple[int, ...], int]]


def reduced(counts: np.ndarray) -> tuple[Sets, np.ndarray]:
    """Sets of lengths fixed by dominance, each with its number of sequences, and the counts left.

    A set stays dominating while its lengths last, since taking pieces away only removes
    fillings it must dominate, so it is fixed for all its copies at once.
    """
    counts, fixed = counts.copy(), []
    changed = True
    while changed:
        changed = False
        for longest in range(len(counts) - 1, 0, -1):
            while counts[longest]:
                others = dominating(counts, longest)
                if others is None:
                    break
                lengths, needed = np.unique([longest, *others], return_counts=True)
                times = int((counts[lengths] // needed).min())
                counts[lengths] -= needed * times
                fixed.append(((longest, *others), times))
                changed = True
    return fixed, counts


# Best fit ------------------------------------------------------------------------------------

# What equal sequences hold: (length, how many of it), in order of placing.
Filling = tuple[tuple[int, int], ...]


def best_fit(counts: np.ndarray) -> list[tuple[Filling, int]]:
    """Best fit by decreasing length: fillings and the number of sequences of each.

    Sequences filled alike are one case. A piece goes to the least room that holds it; its
    sequence then has the least room of all, so pieces of one length fill sequence by sequence.
    """
    capacity = len(counts) - 1
    closed: list[tuple[Filling, int]] = []
    rooms: list[int] = []
    alike: dict[int, list[tuple[Filling, int]]] = {}

    def put(filling: Filling, times: int, room: int) -> None:
        if not room:
            closed.append((filling, times))
        elif times:
            if room not in alike:
                alike[room] = []
                insort(rooms, room)
            alike[room].append((filling, times))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filling, times = alike[room].pop()
                if not alike[room]:
                    del alike[room], rooms[at]
            else:
                # As many new ones as the rest of this length fills.
                room, filling, times = capacity, (), left
            each = room // length
            full = min(times, left // each)
            if full:
                put((*filling, (length, each)), full, room - each * length)
                left -= full * each
            if full < times:
                if left:
                    put((*filling, (length, left)), 1, room - left * length)
                    full, left = full + 1, 0
                if filling:
                    put(filling, times - full, room)
    return closed + [case for room in rooms for case in alike[room]]


# The plan ------------------------------------------------------------------------------------


class Plan(NamedTuple):
    """Row i: pieces of length ``length[i]`` numbered (from 0) from ``first[i]`` up go, ``each[i]``
    to a sequence, to the sequences from ``sequence[i]`` on, at ``offset[i]`` and after.
    Rows are in order of length and first number."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces, by length and number within the length."""
        # One search for all lengths: the numbers of a length lie in a stretch of their own.
        stretch = int(max(self.first.max(initial=0), number.max(initial=0))) + 1
        row = np.searchsorted(self.length * stretch + self.first, length * stretch + number, side="right") - 1
        step = number - self.first[row]
        return self.sequence[row] + step // self.each[row], self.offset[row] + step % self.each[row] * length


def plan_packing(counts: np.ndarray) -> Plan:
    """Where the pieces go, ``counts[n]`` of length n; the last index is the capacity."""
    fixed, rest = reduced(counts)
    cases = [(tuple((n, 1) for n in lengths), times) for lengths, times in fixed] + best_fit(rest)
    taken, rows, sequence = np.zeros(len(counts), np.int64), [], 0
    for filling, times in cases:
        offset = 0
        for length, each in filling:
            rows.append((length, int(taken[length]), each, sequence, offset))
            taken[length] += each * times
            offset += each * length
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequence)


# On Spark ------------------------------------------------------------------------------------

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END,
    model: str | None = None, ranks: str | None = None, with_ids: bool = True,
) -> DataFrame:
    """The token pieces of every row: PIECES and, with ``with_ids``, their token ids.

    Each document is its token ids and the id ``end``; a null text is empty, so its one piece
    is the end. Rows are cut alone; other columns are not read.
    """
    model, ranks = model or public_tokenizers.path(MODEL), ranks or public_tokenizers.path(RANKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(model, ranks)
        for batch in small_pieces(batches, 1):
            rows, held = [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(tokens(value or ""), np.uint32(end)).astype("<u4")
                for number, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((key, number, start, length, zlib.crc32(part.tobytes())))
                    held.append(part)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)]
            if with_ids:
                ends = np.cumsum([0, *map(len, held)])
                values = pa.array(np.concatenate(held).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values))
            yield pa.RecordBatch.from_arrays(columns, names=[*NAMES, "ids"][: len(columns)])

    picked = docs.select(F.col(id).cast("bigint"), F.col(text).cast("string"))
    return picked.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


NAMES = [part.split()[0] for part in PIECES.split(", ")]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def packed(cut: DataFrame, *, length: str = "length", order: Sequence[str] = NAMES, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with sequence_id and offset: every row placed in a sequence of at most
    ``capacity`` tokens, rows of a sequence without gaps from 0.

    ``length`` is from 1 to ``capacity``. Rows equal in ``order`` may take each other's place.
    The driver sees one count per length. Rows are written and numbered in range slices, so
    a length that a third of the rows have spreads over tasks. Starts jobs when the plan is built.
    """
    rows = written(cut)
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy(F.col(length).alias("n")).agg(F.count(F.lit(1)).alias("k")).collect():
        counts[r["n"]] = r["k"]
    plan, before = plan_packing(counts), np.cumsum(counts) - counts
    ranked = numbered(rows, "_rank", order_by=[length, *[c for c in order if c != length]], start=0)
    at = ranked.columns.index(length), ranked.columns.index("_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in at)
            sequence, offset = plan.place(sizes, ranks - before[sizes])
            kept = [batch.column(i) for i in range(batch.num_columns) if i != at[1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    names = [*[c for c in ranked.columns if c != "_rank"], "sequence_id", "offset"]
    return ranked.mapInArrow(
        place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id bigint, offset bigint"
    )


def pack_documents(docs: DataFrame, **how) -> DataFrame:
    """Documents cut into pieces (:func:`pieces`, whose arguments ``how`` takes) and packed.

    One row per piece: PIECES, ids where asked for, sequence_id and offset. Empty and null
    texts are one piece of one token; repeated rows and null ids are documents of their own;
    an empty table gives no rows.
    """
    return packed(pieces(docs, **how), capacity=how.get("capacity", CAPACITY))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, doc_ids): the packed sequences, from pieces with ids.

    A sequence gathers at most its capacity of tokens, whatever the number of documents."""
    part = F.struct("offset", "doc_id", "ids")
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(part)).alias("_parts")
    ).select(
        "sequence_id", "length", F.flatten("_parts.ids").alias("ids"), F.col("_parts.doc_id").alias("doc_ids")
    )
