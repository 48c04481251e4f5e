"""Mined phrases against plain counting; the trie against a dictionary."""

import re
import uuid
from collections import Counter

import numpy as np
import pytest

from tallywork.llm.double_array import DoubleArray
from tallywork.llm.phrase_mining import (
    BREAK,
    END,
    FOLD,
    Filter,
    Levels,
    Settings,
    Trie,
    _different,
    _encoded,
    deal_windows,
    encoded,
    frequent_phrases,
    make_both,
    make_filter,
    mine_phrases,
    phrase_hashes,
    windows,
)
from tallywork.session import written

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, phrase string, rank int, n int"


def plain(data, s):
    """The contract, counted with dictionaries."""
    n, f = Counter(), Counter()
    for text, lang in data:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, s.max_words + 1):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= s.min_count}
    rows = {}
    for (lang, p), a in often.items():
        holders = (
            b for (other, q), b in often.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
        )
        if any(100 * b >= s.covered_percent * a for b in holders):
            continue
        score, k = min((s.scale * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in rows.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[: s.top], 1)
    )


def texts(seed, documents=150):
    rng = np.random.default_rng(seed)
    words = np.array(["New", "york", "times", "a", "b", "c", "is", "é", "ÉX", "x y", "\x1c"] + [f"w{i}" for i in range(60)])
    data = []
    for i in range(documents):
        picked = words[np.minimum(rng.zipf(1.4, rng.integers(0, 120)), len(words)) - 1]
        gaps = rng.choice([" ", "  ", "\t", ", ", "\n", "\r\n", "."], len(picked), p=[0.7, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03])
        text = "".join(w + g for w, g in zip(picked, gaps, strict=True))
        data.append((text, [None, "en", "fr", "und"][i % 4]))
    return data + [(None, "en"), ("", None), (" \t.", "de"), ("new york times " * 200, "en"), ("a a a a " * 30, "fr")] + data[:3]


SETS = [
    Settings(min_count=5, top=40),
    Settings(min_count=3, top=2000, max_words=4, covered_percent=80),
    # Tiny bounds: tasks combine early, several tries, a filter that lets much through.
    Settings(min_count=4, top=100, held=64, trie_phrases=40, filter_bits=1 << 16),
]


@pytest.mark.parametrize("settings", SETS)
def test_equals_plain(spark, settings):
    data = texts(settings.min_count)
    df = spark.createDataFrame([(i, t, l, "x", 1, 2) for i, (t, l) in enumerate(data)], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in mine_phrases(df, settings=settings).collect())
    assert got == plain(data, settings) and got


def test_only_frequent_phrases_come_out_of_the_levels(spark):
    df = spark.createDataFrame([("p q r " * 12 + "z",), ("p q",), ("solo duo",)], "text string").selectExpr("text", "'en' AS lang")
    words, phrases = frequent_phrases(df)
    assert {(r.word, r.f) for r in words.collect()} == {("p", 13), ("q", 13), ("r", 12), (None, 41)}
    assert {(r.words, r.phrase, r.f) for r in phrases.collect()} == {
        (2, "p q", 13), (2, "q r", 12), (2, "r p", 11), (3, "p q r", 12), (3, "q r p", 11), (3, "r p q", 11)
    }


def test_tokens():
    words, codes = _encoded("The  a\t\xe9a. b,,\x1c\nTHE".encode().translate(FOLD) + END + END)
    assert [words[c] for c in codes] == [b"the", b"a", "\xe9a".encode(), BREAK, b"b", BREAK, BREAK, b"\x1c", BREAK, b"the", END, END]


@pytest.mark.parametrize("settings", SETS[1:])
def test_phrases_that_share_a_hash_are_all_found(spark, settings):
    """With hashes of a few bits nearly every hash stands for several phrases."""
    data = texts(9, 80)
    df = spark.createDataFrame([(i, t, l, "x", 1, 2) for i, (t, l) in enumerate(data)], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in mine_phrases(df, settings=settings._replace(hash_bits=6)).collect())
    assert got == plain(data, settings) and got


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    from tallywork.llm import phrase_mining as pm

    words = spark.createDataFrame([("en", None, 10**13), ("en", "a", 3 * 10**12), ("en", "b", 2 * 10**12 + 1)], "lang string, word string, f bigint")
    pairs = spark.createDataFrame([(2, "en", "a b", 10**12 + 7)], "words int, lang string, phrase string, f bigint")
    r = pm._scored(words, pairs, Settings()).first()
    assert r.score == 10**6 * (10**12 + 7) ** 2 // (3 * 10**12 * (2 * 10**12 + 1)) and (r.l, r.r) == (3 * 10**12, 2 * 10**12 + 1)


def test_empty(frame):
    assert mine_phrases(frame([], "text string, lang string")).collect() == []
    assert mine_phrases(frame([(None, None), ("", "en"), ("one", "en")], "text string, lang string")).collect() == []


@pytest.mark.parametrize(("n", "symbols", "length"), [(1, 1, 2), (60, 10, 2), (3000, 300, 3), (40000, 70000, 2)])
def test_trie(n, symbols, length):
    rng = np.random.default_rng(n)
    paths = np.unique(np.column_stack([rng.integers(1, 3, n), *(np.minimum(rng.zipf(1.3, n), symbols) for _ in range(length))]), axis=0)
    paths = paths[rng.permutation(len(paths))]
    trie = DoubleArray.of(paths, np.arange(len(paths)) * 7, max(symbols, 2))
    text = np.minimum(rng.zipf(1.3, 20000), symbols)
    text[rng.random(len(text)) < 0.1] = 0
    ids = {tuple(p): 7 * i for i, p in enumerate(paths.tolist())}
    for lang in set(paths[:, 0].tolist()):
        start, _ = trie.step(np.zeros(1, np.int32), np.zeros(1, np.int64), np.array([lang]))
        got = trie.ids_of(trie.matches(int(start[0]), text, length))
        want = (ids.get((lang, *text[i : i + length].tolist())) for i in range(len(text) - length + 1))
        assert Counter(got.tolist()) == Counter(w for w in want if w is not None)


def test_trie_knows_its_languages():
    trie = Trie.of(["en", "de"], ["a b", "a c"], np.array([4, 9]))
    assert trie.start("fr") is None and trie.start("en") != trie.start("de")


def test_filter(spark):
    hashes = np.unique(np.random.default_rng(1).integers(1, 1 << 63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    made = make_filter(written(spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h bigint")), Settings())
    assert isinstance(made, Filter) and made.has(hashes).all()
    others = np.random.default_rng(2).integers(1, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    assert made.has(others).mean() < 0.05


def test_windows():
    h = np.array([5, 0, 7, 8, 9], np.uint64)
    assert (windows(h, 2) != 0).tolist() == [False, False, True, True] and (windows(h, 3) != 0).tolist() == [False, False, True]
    assert windows(h, 6).tolist() == [] and windows(h, 1).tolist() == h.tolist()


def test_texts_are_read_once_however_many_tries_there_are(spark, tmp_path):
    """Every trie once read all texts again, so passes over them grew with the number of phrases."""
    settings = Settings(min_count=4, top=100, max_words=2, trie_phrases=100)
    data = texts(11, 60)

    def noted(batches):
        (tmp_path / uuid.uuid4().hex).touch()
        yield from batches

    df = spark.createDataFrame([(i, t, l, "x", 1, 2) for i, (t, l) in enumerate(data)], SCHEMA).repartition(3)
    df = df.select("lang", "text").mapInArrow(noted, "lang string, text string")
    got = sorted(tuple(r) for r in mine_phrases(df, settings=settings).collect())
    assert got == plain(data, settings) and got
    assert len(list(tmp_path.iterdir())) == 3


def test_each_group_is_dealt_its_own_windows_once(spark):
    settings, data = Settings(min_count=2, max_words=2), [("a b c a b", "en"), ("a b c", "en"), ("a b c", "de"), ("x. y", None)]
    blocks = encoded(spark.createDataFrame([(l or "und", t) for t, l in data], "lang string, text string").repartition(2), settings)
    hashes = written(spark.createDataFrame([("en", w) for w in "abc"] + [("de", w) for w in "abc"], "lang string, phrase string"))
    levels = Levels(make_filter(phrase_hashes(hashes), settings), {}, 64)
    pairs = written(spark.createDataFrame([(l, p) for l in ("en", "de") for p in ("a b", "b c")], "lang string, phrase string"))
    found = phrase_hashes(pairs)
    dealt = deal_windows(blocks, levels, {2: make_filter(found, settings)}, {2: 3}, 6)
    count, home = Counter(), {(r.lang, r.phrase): (r.h & (1 << 64) - 1) // 2 % 3 for r in found.collect()}
    for r in dealt.collect():
        names = r.names.split(b" ")
        for row, n in zip(np.frombuffer(r.windows, np.uint32).reshape(-1, 2), np.frombuffer(r.counts, np.uint32).tolist(), strict=True):
            phrase = (r.lang, b" ".join(names[i] for i in row).decode())
            assert r.g == home[phrase]
            count[phrase] += n
    assert count == {("en", "a b"): 3, ("en", "b c"): 2, ("de", "a b"): 1, ("de", "b c"): 1}


def test_different_sequences_are_counted_beyond_64_bits():
    rng = np.random.default_rng(5)
    codes = np.where(rng.random(400) < 0.1, 1 << 22, rng.integers(0, 3, 400)).astype(np.uint32)
    at = np.arange(0, 396)
    first, counts = _different(codes, at, 4)
    assert dict(zip((tuple(codes[i : i + 4]) for i in first), counts.tolist(), strict=True)) == Counter(tuple(codes[i : i + 4]) for i in at)


def test_two_filters_let_less_through(spark):
    hashes, others = (np.random.default_rng(i).integers(0, 1 << 63, 40_000).astype(np.uint64) * np.uint64(2) + np.uint64(i) for i in (0, 1))
    given = written(spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h bigint"))
    settings = Settings(filter_bits=1 << 16)
    one, both = make_filter(given, settings), make_both(given, settings)
    assert both.has(hashes).all() and both.has(others).mean() < 0.6 * one.has(others).mean()
