"""Which windows of a fixed length occur more than once in a corpus, found at scale.

Shared by the two operators that remove repeated passages. The work has two shuffles of
compact rows, and one of the texts:

1. Every text is cut into the spans of :mod:`anchors`. A span is one row of numbers: the
   hash of its anchor, the hash of its symbols, where it lies. Spans meet by anchor. Equal
   spans repeat whole, which settles nearly everything inside copies and long passages.
2. Spans with the same anchor but different symbols may still share some of their windows
   (at the edges of a passage, or by chance). Only these go on: a text that has some is
   read again, and the spans of an anchor are compared: bytes as text sorted by suffix, words
   by extending the anchor both ways (:mod:`seed_matches`).
3. The ranges found are joined to the texts.

No key can pile up. Copies inside a chunk of a task are merged before the shuffle. An
anchor that has many different spans in one chunk is hot: all its spans are settled window
by window, each window going its own way by a pair of hashes, and only one row a chunk tells
the other chunks so. So is one of words with more than ``SEED_PLACES`` different spans in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.anchors import BASES, BYTE_VALUES, hashed, mixed, pieces, prefix, spans, word_hashes
from tallywork.llm.seed_matches import extended
from tallywork.llm.text import small_pieces, tasks_for, text_bytes, total_bytes
from tallywork.session import written

REMOVED, AS_TEXT, AS_HASHES, AS_SEEDS = 0, 1, 2, 3
# Text whose spans and windows one task of a shuffle holds. A span has about 30 bytes of numbers
# and stands for some 40 symbols, so that is less than the text.
TASK_BYTES = 64 << 20
# Different spans of words around one anchor that are extended in one task.
SEED_PLACES = 1 << 12
# Spans whose words are sent as one batch: some 25 MB.
_SENT = 50_000
MANY = 1 << 8
HOT = 1 << 9


class Rule(NamedTuple):
    """``keep_first``: the earliest occurrence of a window (by id, then position) is no
    repeat; otherwise every window that occurs twice is one. ``suffix_sort``: differing spans are
    sorted by suffix, otherwise their anchor is extended. A task sends its spans in
    chunks of ``chunk_spans``; an anchor with more than ``hot_spans`` different spans in one
    is hot. These two only decide how the work is spread."""

    words: bool
    k: int
    length: int
    keep_first: bool
    suffix_sort: bool
    chunk_spans: int = 400_000
    hot_spans: int = 8


def _symbols(column: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts of a column, and where each text ends."""
    data, offsets = text_bytes(column)
    if not words:
        return BYTE_VALUES[data], offsets[1:]
    # A word never crosses from one text to the next: a space is put in between.
    spread = np.full(len(data) + len(offsets), 32, np.uint8)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    spread[np.arange(len(data)) + row] = data
    opens, _, values = word_hashes(spread)
    return values, np.searchsorted(opens, offsets[1:] + np.arange(len(offsets) - 1))


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] numbers), first[1], ..."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - count - first, count)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (the last two order inside a group); group number of each row in
    that order. A group is rows equal in all but the last two keys."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    for key in keys[:-2]:
        ordered = key[order]
        change[1:] |= ordered[1:] != ordered[:-1]
    return order, np.cumsum(change)


def _joined(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges [a, b) of each id, touching and overlapping ones made one."""
    if not len(ids):
        return ids, a, b
    order = np.lexsort((b, a, ids))
    ids, a, b = ids[order], a[order], b[order]
    turn = np.concatenate([[True], ids[1:] != ids[:-1]])
    # The furthest end so far within an id, as one running maximum over shifted values.
    shift = np.cumsum(turn) * (int(b.max()) + 1)
    reach = np.maximum.accumulate(b + shift) - shift
    opens = turn | np.concatenate([[True], a[1:] > reach[:-1]])
    at = np.flatnonzero(opens)
    return ids[at], a[at], np.maximum.reduceat(b, at)


def _settle(order: np.ndarray, group: np.ndarray, weight: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in groups: (numbers of the rows that are repeats, the first row of each group).

    ``weight`` is how many occurrences a row stands for; of one that stands for several the
    repeats are already known.
    """
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else group
    if rule.keep_first:
        later = np.ones(len(order), bool)
        later[heads] = False
        return order[later], order[heads]
    total = np.bincount(group, weights=weight[order], minlength=len(heads)) if len(group) else weight
    return order[(total[group] > 1) & (weight[order] == 1)], order[heads]


def _batch(values: dict[str, np.ndarray | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) for f in schema], schema=schema)


SPAN_SCHEMA = (
    "bucket int, key array<bigint>, span array<bigint>, id array<bigint>, first array<int>, "
    "packed array<smallint>, other_id array<bigint>, a array<int>, b array<int>, kind array<tinyint>, "
    "weight array<tinyint>"
)
FOUND_SCHEMA = "id bigint, a int, b int, kind tinyint, weight tinyint, key bigint"
_LISTS = {
    "key": pa.int64(), "span": pa.int64(), "id": pa.int64(), "first": pa.int32(), "packed": pa.int16(),
    "other_id": pa.int64(), "a": pa.int32(), "b": pa.int32(), "kind": pa.int8(), "weight": pa.int8(),
}
_SPAN_ARROW = pa.schema([("bucket", pa.int32()), *((n, pa.list_(t)) for n, t in _LISTS.items())])
_FOUND_ARROW = pa.schema(
    [("id", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("kind", pa.int8()), ("weight", pa.int8()), ("key", pa.int64())]
)


def _span_rows(rule: Rule, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, span, ids, first, last = (np.concatenate(x) for x in zip(*held, strict=True))
        # Merge what repeats inside the chunk.
        order, group = _groups(key, span, ids, first)
        again, heads = _settle(order, group, np.ones(len(key)), rule)
        weight = np.minimum(np.bincount(group), 2)
        gone = (ids[again], first[again], last[again] + rule.length)
        key, span, ids, first, last = (x[heads] for x in (key, span, ids, first, last))
        # Hot anchors: every span of theirs is settled by windows, one row stays to say so.
        turn = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        many = np.diff(np.concatenate([turn, [len(key)]]))
        hot = np.repeat(many > rule.hot_spans, many)
        marker = np.zeros(len(key), bool)
        marker[turn[many > rule.hot_spans]] = True
        ids_g, a_g, b_g = _joined(*gone)
        other = {
            "other_id": np.concatenate([ids_g, ids[hot]]),
            "a": np.concatenate([a_g, first[hot]]),
            "b": np.concatenate([b_g, last[hot] + rule.length]),
            "kind": np.repeat([REMOVED, AS_HASHES], [len(ids_g), int(hot.sum())]),
            "weight": np.concatenate([np.ones(len(ids_g), np.int64), weight[hot]]),
        }
        sent = marker | ~hot
        main = {
            "key": key[sent].view(np.int64),
            "span": span[sent].view(np.int64),
            "id": ids[sent],
            "first": first[sent],
            "packed": ((last - first) + MANY * (weight > 1) + HOT * marker)[sent],
        }
        columns = {}
        for values, bucket in (
            (main, key[sent] % np.uint64(buckets)),
            (other, mixed(other["other_id"].view(np.uint64) + np.uint64(1)) % np.uint64(buckets)),
        ):
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).astype(np.int32)
            for name, value in values.items():
                columns[name] = pa.ListArray.from_arrays(pa.array(cuts), pa.array(value[order], _LISTS[name]))
        columns["bucket"] = pa.array(np.arange(buckets, dtype=np.int32))
        rows = pa.RecordBatch.from_arrays([columns[f.name] for f in _SPAN_ARROW], schema=_SPAN_ARROW)
        # With more buckets than spans most have none.
        yield rows.filter(pa.array(np.maximum(*(np.asarray(columns[n].value_lengths()) for n in ("key", "other_id"))) > 0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in small_pieces(batches, 1):
            ids = batch.column(0).to_numpy()
            symbols, ends = _symbols(batch.column(1), rule.words)
            for low, high in pieces(len(symbols), rule.length):
                # A piece of a batch of one very long text; otherwise the whole batch.
                found = spans(symbols[low:high], np.clip(ends, low, high) - low, rule.k, rule.length)
                if not len(found.key):
                    continue
                row = np.searchsorted(ends, found.first + low, side="right")
                base = np.concatenate([[0], ends])[row] - low
                held.append((found.key, found.span, ids[row], found.first - base, found.last - base))
                count += len(found.key)
            if count >= rule.chunk_spans:
                yield from flush(held)
                held, count = [], 0
        if held:
            yield from flush(held)

    return rows


def _lists(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in names]


def _found_rows(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            ids, a, b, kind, weight = _lists(batch, "other_id", "a", "b", "kind", "weight")
            yield _batch(
                {"id": ids, "a": a, "b": b, "kind": kind, "weight": weight, "key": np.zeros(len(ids), np.int64)},
                _FOUND_ARROW,
            )
            held.append(_lists(batch, "key", "span", "id", "first", "packed"))
        if not held:
            return
        key, span, ids, first, packed = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        if not len(key):
            return
        last = first + (packed & (MANY - 1))
        weight = np.where(packed & MANY, 2, 1)
        order = np.argsort(key, kind="stable")
        turn = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
        size = np.diff(np.concatenate([turn, [len(key)]]))
        hot = np.zeros(len(key), bool)
        hot[order] = np.repeat(np.bitwise_or.reduceat(packed[order], turn) & HOT > 0, size)

        def out(rows, kind: int, weight) -> pa.RecordBatch:
            n = len(rows)
            return _batch(
                {"id": ids[rows], "a": first[rows], "b": last[rows] + rule.length, "kind": np.full(n, kind),
                 "weight": np.broadcast_to(weight, n), "key": key[rows]}, _FOUND_ARROW,
            )

        loose = np.flatnonzero(hot & (packed & HOT == 0))
        yield out(loose, AS_HASHES, weight[loose])
        cold = np.flatnonzero(~hot)
        order, group = _groups(key[cold], span[cold], ids[cold], first[cold])
        again, heads = _settle(order, group, weight[cold], rule)
        yield out(cold[again], REMOVED, 1)
        # One span stands for all that equal it; where its anchor has others, compare windows.
        total = np.bincount(group, weights=weight[cold][order]) if len(order) else np.zeros(0)
        heads_key = key[cold][heads]
        turn = np.flatnonzero(np.concatenate([[True], heads_key[1:] != heads_key[:-1]])) if len(heads) else heads
        size = np.diff(np.concatenate([turn, [len(heads)]]))
        size, total = np.repeat(size, size), np.minimum(total, 2)
        if rule.suffix_sort:
            yield out(cold[heads[size > 1]], AS_TEXT, total[size > 1])
            return
        few = (size > 1) & (size <= SEED_PLACES)
        yield out(cold[heads[few]], AS_SEEDS, total[few])
        yield out(cold[heads[size > SEED_PLACES]], AS_HASHES, total[size > SEED_PLACES])

    return rows


WINDOW_SCHEMA = "key bigint, check bigint, id bigint, at int, kind tinyint, weight tinyint, text binary"
_WINDOW_ARROW = pa.schema(
    [("key", pa.int64()), ("check", pa.int64()), ("id", pa.int64()), ("at", pa.int32()), ("kind", pa.int8()), ("weight", pa.int8()), ("text", pa.binary())]
)


def _window_rows(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, text, found: list of (a, b, kind, weight, key)) to rows to compare."""

    def as_text(batch: pa.RecordBatch, field: dict[str, np.ndarray], row: np.ndarray) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column(1))
        raw = data.tobytes()
        at = offsets[row]
        texts = [raw[p + a : p + b] for p, a, b in zip(at.tolist(), field["a"].tolist(), field["b"].tolist(), strict=True)]
        n = len(texts)
        return _batch(
            {"key": field["key"], "check": np.zeros(n, np.int64), "id": batch.column(0).to_numpy()[row],
             "at": field["a"], "kind": np.full(n, AS_TEXT), "weight": field["weight"], "text": pa.array(texts, pa.binary())},
            _WINDOW_ARROW,
        )

    def as_hashes(batch: pa.RecordBatch, field: dict[str, np.ndarray], row: np.ndarray) -> pa.RecordBatch:
        symbols, ends = _symbols(batch.column(1), rule.words)
        base = np.concatenate([[0], ends])[:-1][row]
        count = field["b"].astype(np.int64) - field["a"] - rule.length + 1
        start = _ranges(base + field["a"], count)
        first, second = (
            mixed(hashed(prefix(symbols, base_), start, start + rule.length, base_)) for base_ in BASES
        )
        ids = batch.column(0).to_numpy()[np.repeat(row, count)]
        at = start - np.repeat(base, count)
        weight = np.repeat(field["weight"], count)
        order, group = _groups(first, second, ids, at)
        again, heads = _settle(order, group, weight, rule)
        total = np.minimum(np.bincount(group, weights=weight[order]), 2)
        rows = np.concatenate([again, heads])
        n = len(rows)
        return _batch(
            {"key": first[rows].view(np.int64), "check": second[rows].view(np.int64), "id": ids[rows], "at": at[rows],
             "kind": np.repeat([REMOVED, AS_HASHES], [len(again), len(heads)]),
             "weight": np.concatenate([np.ones(len(again)), total]), "text": pa.nulls(n, pa.binary())},
            _WINDOW_ARROW,
        )

    def as_seeds(batch: pa.RecordBatch, field: dict[str, np.ndarray], row: np.ndarray) -> Iterator[pa.RecordBatch]:
        symbols, ends = _symbols(batch.column(1), rule.words)
        n = len(symbols)
        sums = prefix(symbols, BASES[0])
        grams = mixed(hashed(sums, slice(0, n - rule.k + 1), slice(rule.k, n + 1), BASES[0])).view(np.int64)
        base = np.concatenate([[0], ends])[:-1]
        for low in range(0, len(row), _SENT):
            part = {name: v[low : low + _SENT] for name, v in field.items()}
            some = row[low : low + _SENT]
            size = part["b"].astype(np.int64) - part["a"]
            start = base[some] + part["a"]
            # The anchor is the first of its hash in a span.
            count = size - rule.k + 1
            is_anchor = grams[_ranges(start, count)] == np.repeat(part["key"], count)
            owner = np.repeat(np.arange(len(some)), count)[is_anchor]
            offset = _ranges(np.zeros(len(some), np.int64), count)[is_anchor][np.unique(owner, return_index=True)[1]]
            cuts = np.concatenate([[0], 8 * np.cumsum(size)]).astype(np.int32)
            words = symbols[_ranges(start, size)]
            yield _batch(
                {"key": part["key"], "check": offset, "id": batch.column(0).to_numpy()[some], "at": part["a"],
                 "kind": np.full(len(some), AS_SEEDS), "weight": part["weight"],
                 "text": pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(cuts), pa.py_buffer(words)])},
                _WINDOW_ARROW,
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_pieces(batches, 1):
            lists = batch.column("found")
            row = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            items = lists.flatten()
            field = {n: items.field(n).to_numpy(zero_copy_only=False) for n in ("a", "b", "kind", "weight", "key")}
            for kind, make in ((AS_TEXT, as_text), (AS_HASHES, as_hashes), (AS_SEEDS, as_seeds)):
                picked = field["kind"] == kind
                if picked.any():
                    made = make(batch, {n: v[picked] for n, v in field.items()}, row[picked])
                    yield from [made] if isinstance(made, pa.RecordBatch) else made

    return rows


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit numbers of a column of bytes, end to end, and the byte offsets of its rows."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint64), offsets


_RANGE_ARROW = pa.schema([("id", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def suffix_repeats(texts: list[bytes], ids: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of the phrases, as deep as ``length`` bytes, read for repeats.

    Suffixes of ``length`` bytes or more are sorted; those that agree on their first
    ``length`` bytes are neighbours. Of each such run the suffix first in the corpus (by
    the phrase's place in the parse: id, then position) stays; returns (id, position) of
    all others.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    count = sizes - length + 1
    begin = np.cumsum(sizes) - sizes
    start = _ranges(begin, count)
    owner = np.repeat(np.arange(len(texts)), count)
    place = at[owner] + (start - begin[owner])
    windows = np.lib.stride_tricks.sliding_window_view(data, length)[start]
    order = np.lexsort((place, ids[owner]))
    order = order[np.argsort(windows[order].view(f"S{length}").ravel(), kind="stable")]
    ordered = windows[order]
    again = np.flatnonzero(np.concatenate([[False], (ordered[1:] == ordered[:-1]).all(axis=1)]))
    return ids[owner[order[again]]], place[order[again]]


def _range_rows(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, phrases, seeds, found = [], [], [], []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            numbers = [batch.column(n).to_numpy() for n in ("key", "check", "id", "at", "weight")]
            hashes.append([x[kind == AS_HASHES] for x in numbers])
            done = kind == REMOVED
            found.append((numbers[2][done], numbers[3][done]))
            if (kind == AS_TEXT).any():
                text = batch.column("text").filter(pa.array(kind == AS_TEXT)).to_pylist()
                phrases.append((text, numbers[0][kind == AS_TEXT], numbers[2][kind == AS_TEXT], numbers[3][kind == AS_TEXT]))
            if (kind == AS_SEEDS).any():
                data, offsets = _binary(batch.column("text").filter(pa.array(kind == AS_SEEDS)))
                seeds.append((data, np.diff(offsets) // 8, *(x[kind == AS_SEEDS] for x in numbers)))
        if hashes:
            key, check, ids, at, weight = (np.concatenate(x) for x in zip(*hashes, strict=True))
            order, group = _groups(key, check, ids, at)
            again, _ = _settle(order, group, weight, rule)
            found.append((ids[again], at[again]))
        if phrases:
            texts = [t for part in phrases for t in part[0]]
            key, ids, at = (np.concatenate([p[i] for p in phrases]) for i in (1, 2, 3))
            # Phrases of one trigger together; a few thousand at a time bound the sorted copy.
            order = np.argsort(key, kind="stable")
            turn = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
            # A step past the start of the last trigger finds none; the end bounds that trigger.
            step = np.searchsorted(turn, np.arange(0, len(order), 4096))
            bounds = np.unique(np.concatenate([turn[step[step < len(turn)]], [len(order)]]))
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                some = order[low:high]
                found.append(suffix_repeats([texts[i] for i in some], ids[some], at[some], rule.length))
        if found:
            ids, at = (np.concatenate(x) for x in zip(*found, strict=True))
            ids, a, b = _joined(ids, at.astype(np.int64), at.astype(np.int64) + rule.length)
            yield _batch({"id": ids, "a": a, "b": b}, _RANGE_ARROW)
        if seeds:
            words, size, key, offset, ids, at, weight = (np.concatenate(x) for x in zip(*seeds, strict=True))
            seeds.clear()
            place, left, right = extended(key, words, np.cumsum(size) - size, size, offset, rule.k, rule.length)
            # Of a place that stands for several equal ones the repeats are known.
            place, left, right = (x[weight[place] == 1] for x in (place, left, right))
            anchor = at[place].astype(np.int64) + offset[place]
            ids, a, b = _joined(ids[place], anchor - left, anchor + right)
            yield _batch({"id": ids, "a": a, "b": b}, _RANGE_ARROW)

    return rows


def repeated_ranges(texts: DataFrame, rule: Rule) -> DataFrame:
    """(id, ranges): for each id with repeats, the ranges [a, b) of its symbols that
    repeated windows cover, as array<struct<a, b>>; they may overlap.

    ``texts`` has the columns id (bigint, unique, no nulls), text and what else a later join by
    id needs: with the same columns Spark deals the texts out once for both.
    """
    width = tasks_for(texts.sparkSession, total_bytes(texts), TASK_BYTES)
    dealt = texts.select("id", "text").mapInArrow(_span_rows(rule, width), SPAN_SCHEMA).repartitionById(width, F.col("bucket"))
    found = written(dealt.mapInArrow(_found_rows(rule), FOUND_SCHEMA))
    open_ = (
        found.filter(F.col("kind") != REMOVED)
        .groupBy("id")
        .agg(F.collect_list(F.struct("a", "b", "kind", "weight", "key")).alias("found"))
    )
    compared = (
        texts.join(open_.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"))
        .select(*texts.columns, "found")
        .mapInArrow(_window_rows(rule), WINDOW_SCHEMA)
        .repartition(width, "key")
        .mapInArrow(_range_rows(rule), "id bigint, a int, b int")
    )
    settled = found.filter(F.col("kind") == REMOVED).select("id", "a", "b")
    return (
        settled.unionByName(compared)
        .groupBy(F.col("id").alias("_id"))
        .agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    )


def covered(ranges: list[dict[str, int]] | None, size: int) -> list[tuple[int, int]]:
    """The ranges clipped to a text of ``size`` symbols, as disjoint maximal runs."""
    if not ranges:
        return []
    a = np.array([r["a"] for r in ranges], np.int64)
    b = np.minimum(np.array([r["b"] for r in ranges], np.int64), size)
    _, a, b = _joined(np.zeros(len(a), np.int64), a, b)
    return [(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if x < y]
