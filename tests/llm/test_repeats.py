"""Both removers of repeated passages against brute force, hot anchors and small chunks included."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallywork.llm import repeats
from tallywork.llm.anchors import BYTE_VALUES, pieces, spans
from tallywork.llm.prefix_free_dedup import RULE as BYTES
from tallywork.llm.prefix_free_dedup import remove_repeated_bytes
from tallywork.llm.repeats import suffix_repeats
from tallywork.llm.seed_extend_dedup import RULE as WORDS
from tallywork.llm.seed_extend_dedup import remove_repeated_words
from tallywork.llm.text import tasks_for, total_bytes

SCHEMA = "doc_id bigint, text string, ranges string"


def plain_bytes(data, length):
    seen, out = set(), {}
    for i, text in sorted(data, key=lambda d: d[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(raw[p : p + length])
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def plain_words(data, length):
    words = {i: (t or "").encode().split() for i, t in data}
    found = Counter(tuple(w[p : p + length]) for w in words.values() for p in range(len(w) - length + 1))
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if found[tuple(w[p : p + length])] > 1:
                gone[p : p + length] = [True] * length
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(left).hexdigest())
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(9)
    word = lambda: rng.choice("the of and river stone über walks 🌊 light seven".split()) + rng.choice(["", "s", "ed", str(rng.randrange(40))])
    prose = lambda n: [word() for _ in range(n)]
    passage, common = prose(60), prose(40)
    out = []
    for i in range(120):
        text = prose(rng.randrange(10, 160))
        if i % 3 == 0:
            at = rng.randrange(len(text))
            text[at:at] = common
        if i % 10 == 1:
            text[3:3] = passage
            text += passage[5:55]
        out.append((i * 7 % 1000, " ".join(text)))
    for i in range(12):
        out.append((2000 + i, out[i][1]))
        out.append((3000 + i, out[i][1].replace("river", "lake", 1)))
    out += [(5000, None), (5001, ""), (5002, "short"), (5003, "a" * 700), (5004, "ab " * 400), (5005, "\0" * 250 + "x"), (5006, "\n".join(["same line of words here"] * 60))]
    return out


@pytest.mark.parametrize("length, k, hot, chunk", [(100, 32, 8, 400_000), (100, 32, 0, 500), (100, 32, 1, 200), (40, 12, 2, 1000), (20, 20, 8, 300)])
def test_bytes(spark, data, length, k, hot, chunk):
    rule = BYTES._replace(length=length, k=k, hot_spans=hot, chunk_spans=chunk)
    df = spark.createDataFrame([(i, t, "") for i, t in data], SCHEMA).repartition(6)
    got = remove_repeated_bytes(df, rule=rule).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == plain_bytes(data, length)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("length, k, hot, chunk", [(35, 12, 8, 400_000), (35, 12, 0, 100), (35, 12, 1, 50), (10, 4, 2, 300)])
def test_words(spark, data, length, k, hot, chunk):
    rule = WORDS._replace(length=length, k=k, hot_spans=hot, chunk_spans=chunk)
    df = spark.createDataFrame([(i, t, "") for i, t in data], SCHEMA).repartition(6)
    got = remove_repeated_words(df, rule=rule).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == plain_words(data, length)
    assert all(sum(x.last - x.first + 1 for x in r.repeats) == r.n_removed for r in got)


def test_no_ids_and_no_rows(spark):
    text = "word%d " * 50 % tuple(range(50))
    df = spark.createDataFrame([(None, text, ""), (1, text, ""), (2, "x", "")], SCHEMA)
    got = {r.doc_id: r.n_removed for r in remove_repeated_bytes(df).collect()}
    assert got[None] == 0 and got[1] == len(text) and got[2] == 0
    got = {r.doc_id: r.n_removed for r in remove_repeated_words(df).collect()}
    assert got == {None: 50, 1: 50, 2: 0}
    assert remove_repeated_bytes(df.limit(0)).count() == 0
    assert remove_repeated_words(df.limit(0)).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 101, 150)
    a = np.concatenate([rng.integers(97, 101, 333), shared, rng.integers(97, 101, 90)])
    b = np.concatenate([rng.integers(97, 101, 51), shared, rng.integers(97, 101, 400)])
    data = np.concatenate([a, b]).astype(np.uint8)
    found = spans(BYTE_VALUES[data], np.array([len(a), len(data)]), 32, 100)
    anchors = np.repeat(found.key, found.last - found.first + 1)
    starts = np.concatenate([np.arange(f, t + 1) for f, t in zip(found.first, found.last, strict=True)])
    assert sorted(starts) == [*range(len(a) - 99), *range(len(a), len(data) - 99)]
    of = dict(zip(starts.tolist(), anchors.tolist(), strict=True))
    assert [of[333 + i] for i in range(51)] == [of[len(a) + 51 + i] for i in range(51)]


def test_pieces_hold_each_window_once():
    for size in (5, 99, 100, 101, 250, 1000):
        cut = pieces(size, 10, most=100)
        starts = [p for low, high in cut for p in range(low, high - 9)]
        assert starts == list(range(max(size - 9, 0)))


def test_suffix_repeats():
    texts = [b"abcabcab", b"xxabcab"]
    ids, at = suffix_repeats(texts, np.array([4, 2]), np.array([10, 0]), 3)
    assert sorted(zip(ids.tolist(), at.tolist(), strict=True)) == [(4, 10), (4, 11), (4, 12), (4, 13), (4, 14), (4, 15)]


@pytest.mark.parametrize("last", [2, 1500])
def test_last_trigger_across_a_step(last):
    """The phrases of the last trigger straddle a multiple of 4096."""
    n = 4097
    key = np.minimum(np.arange(n), n - last)
    texts = [f"{k:0100d}".encode() for k in key]
    batch = repeats._batch(
        {"key": key, "check": np.zeros(n, int), "id": np.arange(n), "at": np.zeros(n, int), "kind": np.full(n, repeats.AS_TEXT),
         "weight": np.ones(n, int), "text": pa.array(texts, pa.binary())}, repeats._WINDOW_ARROW,
    )
    (out,) = repeats._range_rows(BYTES)(iter([batch]))
    assert out.column("id").to_pylist() == list(range(n - last + 1, n))
    assert set(zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)) == {(0, 100)}


def test_rows_without_an_id_of_their_own(spark):
    """Null ids and repeated ids: each row loses only what repeats in it, and one copy stays."""
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared, copied, clean = prose(50), prose(60), [prose(90) for _ in range(4)]
    data = [(None, shared), (None, clean[0]), (None, shared + " " + clean[1]), (5, clean[2]), (5, copied), (5, copied), (6, clean[3])]
    df = spark.createDataFrame([(i, t, "") for i, t in data], SCHEMA).repartition(3)
    got = remove_repeated_bytes(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in data)
    left = Counter(r.kept for r in got)
    assert all(left[c.encode()] == 1 for c in (copied, clean[0], clean[2], clean[3])) and left[b""] >= 1
    assert sum(len(k) * n for k, n in left.items()) == sum(len(t) for _, t in data) - len(copied) - len(shared)
    got = Counter((r.doc_id, r.kept) for r in remove_repeated_words(df).collect())
    want = [(None, ""), (None, clean[0]), (None, clean[1]), (5, clean[2]), (5, ""), (5, ""), (6, clean[3])]
    assert got == Counter(want)


@pytest.mark.parametrize("task_bytes", [1 << 9, 1 << 12])
def test_more_tasks_than_spans_find_the_same(spark, monkeypatch, task_bytes):
    """What a task holds is bounded by bytes: ten times the text takes ten times the tasks."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(20, 120))) for _ in range(60)]
    texts += [texts[i] + " tail " + texts[i + 1] for i in range(0, 30, 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = [{r.doc_id: r.kept_sha256 for r in remove(df).collect()} for remove in (remove_repeated_bytes, remove_repeated_words)]
    monkeypatch.setattr(repeats, "TASK_BYTES", task_bytes)
    width = tasks_for(spark, total_bytes(df), task_bytes)
    assert width > 4 and tasks_for(spark, 10 * total_bytes(df), task_bytes) >= 10 * width - 10
    got = [{r.doc_id: r.kept_sha256 for r in remove(df).collect()} for remove in (remove_repeated_bytes, remove_repeated_words)]
    assert got == want
