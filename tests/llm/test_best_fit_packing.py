"""Packing against exhaustive search, and whole documents read back from their sequences."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallywork.llm import best_fit_packing as packing
from tallywork.llm.best_fit_packing import Tokens, cuts, dominating, pack_documents, packed, plan_packing, reduced, sequences

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def fewest(items, capacity):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {bins[b]: b for b in range(len(bins)) if bins[b] + items[i] <= capacity}.values():
            bins[b] += items[i]
            go(i + 1, bins)
            bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


CASES = st.integers(4, 24).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=9)))


@settings(max_examples=300, deadline=None)
@given(CASES)
def test_the_reduction_loses_no_sequence(case):
    capacity, items = case
    counts = np.bincount(items, minlength=capacity + 1)
    fixed, rest = reduced(counts)
    left = [n for n in range(capacity + 1) for _ in range(rest[n])]
    assert Counter(items) == Counter(left) + Counter(n for lengths, times in fixed for n in lengths * times)
    assert all(sum(lengths) <= capacity for lengths, _ in fixed)
    assert sum(times for _, times in fixed) + (fewest(left, capacity) if left else 0) == fewest(items, capacity)


@settings(max_examples=300, deadline=None)
@given(CASES)
def test_the_plan_places_everything_once(case):
    capacity, items = case
    counts = np.bincount(items, minlength=capacity + 1)
    plan = plan_packing(counts)
    lengths = np.sort(items)
    where = plan.place(lengths, np.concatenate([np.arange(k) for k in counts]))
    held = {}
    for sequence, offset, length in zip(*where, lengths, strict=True):
        held.setdefault(sequence, []).append((offset, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) == plan.sequences >= fewest(items, capacity)


def test_sets_that_dominate():
    counts = lambda *items: np.bincount(items, minlength=11)
    assert dominating(counts(8, 5, 4), 8) == ()
    assert dominating(counts(7, 3, 3, 2, 1), 7) == (3,)
    assert dominating(counts(6, 3, 2, 2), 6) == (2, 2) or dominating(counts(6, 3, 2, 2), 6) is None
    assert dominating(counts(6, 3, 1), 6) == (3, 1)
    assert dominating(counts(4, 1, 1, 1, 1, 2, 3), 4) is None


def test_many_pieces_are_cheap_to_plan():
    rng = np.random.default_rng(0)
    counts = np.bincount(rng.lognormal(5, 1.4, 50_000).astype(int) % 2048 + 1, minlength=2049) * 10**6
    plan = plan_packing(counts)
    least = -(-int((np.arange(2049) * counts).sum()) // 2048)
    assert least <= plan.sequences <= 1.001 * least and len(plan.length) < 20_000


@pytest.mark.parametrize("length", [1, 2047, 2048, 2049, 4096, 5000])
def test_cuts(length):
    found = cuts(length)
    assert sum(n for _, n in found) == length and [s for s, _ in found] == list(np.cumsum([0, *(n for _, n in found)])[:-1])
    assert all(n == 2048 for _, n in found[1:]) and (length > 2048 or len(found) == 1)


def test_tokens_equal_the_library():
    rng = random.Random(1)
    tokens = Tokens(public_tokenizers.path(packing.MODEL), public_tokenizers.path(packing.RANKS))
    kinds = [lambda: chr(rng.randrange(0x250)), lambda: rng.choice(" \n\t\x85\xa0'’€"), lambda: rng.choice("abcdefst12"), lambda: rng.choice("日本Ω🙂́")]
    texts = ["".join(rng.choice(kinds[: rng.choice((3, 4))])() for _ in range(rng.randrange(80))) for _ in range(1500)]
    texts += ["", "a <|endoftext|> b", "<|endoftext|>" * 3, "x" * 50_000, " " * 50_000, "I'll don't ’s"]
    for text in texts:
        assert tokens(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_documents(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "Straße", "don't", "42"]
    data = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 900)))) for i in range(80)]
    data += [(100, "long " * 9000), (101, None), (102, ""), (103, ""), (None, "none"), (None, "none"), (5, data[5][1]), (5, data[5][1])]
    schema = "doc_id bigint, text string, length string, offset string, sequence_id int, _rank int"
    df = spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in data], schema).repartition(5)
    out = pack_documents(df).cache()
    rows = out.collect()
    ids_of = lambda t: [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
    want = Counter()
    for i, t in data:
        ids = ids_of(t)
        want.update((i, p, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()), tuple(ids[s : s + n])) for p, (s, n) in enumerate(cuts(len(ids))))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows) == want
    held = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == held.get(r.sequence_id, 0)
        held[r.sequence_id] = r.offset + r.length
    least = -(-sum(r.length for r in rows) // 2048)
    assert max(held.values()) <= 2048 and least <= len(held) <= least + 1
    whole = sequences(out).collect()
    assert {r.sequence_id: len(r.ids) for r in whole} == held == {r.sequence_id: r.length for r in whole}
    where = {r.sequence_id: r for r in whole}
    assert all(where[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids for r in rows)


def test_one_length_spreads(spark):
    """Most rows of one length: numbered in slices. No small set dominates here, so all is best fit."""
    df = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "if(id % 10 < 9, 3L, 5L) AS length", "0L AS ids_crc32")
    out = packed(df, capacity=16).collect()
    used = Counter()
    for r in out:
        used[r.sequence_id] += r.length
    assert len(out) == 5000 and max(used.values()) <= 16
    # Three fives to a sequence, the last two with two threes; then five threes to a sequence.
    assert len(used) == 167 + -(-(4500 - 2) // 5)


def test_empty(frame):
    assert pack_documents(frame([], "doc_id bigint, text string")).collect() == []
