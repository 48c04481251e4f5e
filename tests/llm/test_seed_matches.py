"""Seeds extended both ways, against comparing every pair of places."""

import random

import numpy as np
import pytest

from tallywork.llm import repeats, seed_matches
from tallywork.llm.seed_extend_dedup import RULE, remove_repeated_words
from tallywork.llm.seed_matches import _Least, extended


def by_pairs(places, k, length):
    """(place, left) -> furthest right agreement of any other place with the same seed."""
    out = {}
    for i, (key, words, at) in enumerate(places):
        for j, (other_key, other, other_at) in enumerate(places):
            if i == j or key != other_key:
                continue
            left = 0
            while left < min(at, other_at, length - k) and words[at - 1 - left] == other[other_at - 1 - left]:
                left += 1
            right = 0
            while right < min(len(words) - at, len(other) - other_at, length) and words[at + right] == other[other_at + right]:
                right += 1
            for o in range(left + 1):
                if right >= k and o + right >= length:
                    out[i, o] = max(out.get((i, o), 0), right)
    return out


@pytest.mark.parametrize("step", [1, 40, 1 << 14])
@pytest.mark.parametrize("alphabet", [1, 2, 3])
def test_equals_all_pairs(monkeypatch, step, alphabet):
    monkeypatch.setattr(seed_matches, "STEP", step)
    rng = random.Random(alphabet)
    k, length = 2, 6
    places = []
    for _ in range(150):
        key = rng.randrange(5)
        before, after = rng.randrange(length - k + 1), rng.randrange(length - k + 1)
        words = [rng.randrange(1, alphabet + 1) for _ in range(before)] + [100 + key] * k + [rng.randrange(1, alphabet + 1) for _ in range(after)]
        places.append((key, words, before))
    size = np.array([len(w) for _, w, _ in places])
    found = extended(
        np.array([p[0] for p in places]), np.concatenate([p[1] for p in places]).astype(np.uint64),
        np.cumsum(size) - size, size, np.array([p[2] for p in places]), k, length,
    )
    got = {(int(i), int(o)): int(r) for i, o, r in zip(*found, strict=True)}
    assert got == by_pairs(places, k, length) and len(got) == len(found[0])
    assert got


def test_equal_seed_numbers_with_other_words_do_not_match():
    words = np.array([1, 2, 3, 4, 1, 9, 3, 4], np.uint64)
    found = extended(np.zeros(2, int), words, np.array([0, 4]), np.array([4, 4]), np.array([0, 0]), 2, 3)
    assert not len(found[0])


def test_no_places():
    none = np.zeros(0, np.int64)
    assert all(not len(part) for part in extended(none, none.view(np.uint64), none, none, none, 12, 35))


def test_least_of_runs():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 50, 37)
    low, high = np.array([(a, b) for a in range(37) for b in range(a + 1, 38)]).T
    assert _Least(values).of(low, high).tolist() == [values[a:b].min() for a, b in zip(low, high, strict=True)]


@pytest.mark.parametrize("most", [1, 4096])
def test_a_long_match_is_one_repeat(spark, monkeypatch, most):
    """Two texts share 200 words in differing surroundings; with ``most`` 1 every seed with
    differing places takes the way of frequent ones."""
    monkeypatch.setattr(repeats, "SEED_PLACES", most)
    rng = random.Random(4)
    prose = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, short = prose(200), prose(34)
    data = [(1, prose(50) + shared + prose(20)), (2, prose(7) + shared + prose(90)), (3, prose(30) + short), (4, short + prose(30))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in data], "doc_id bigint, text string")
    got = {r.doc_id: [(x.first, x.last) for x in r.repeats] for r in remove_repeated_words(df, rule=RULE).collect()}
    assert got == {1: [(50, 249)], 2: [(7, 206)], 3: [], 4: []}
