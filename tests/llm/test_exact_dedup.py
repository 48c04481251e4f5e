import hashlib

import pytest
from conftest import rows

from tallywork.llm import exact_dedup
from tallywork.llm.exact_dedup import exact_duplicates, without_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["Same", "sAME", "É same", "é same", "É SAME", "", None, "one", "x" * 500000, "X" * 500000, "same "]


def plain(data):
    groups = {}
    for i, t in data:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    return sorted(
        (
            (i, max((x for x in g if x is not None), default=None), len(g), i == max((x for x in g if x is not None), default=None),
             hashlib.sha256(k.encode()).hexdigest())
            for k, g in groups.items()
            for i in g
        ),
        key=repr,
    )


@pytest.fixture(params=[1, 1 << 20])
def filter_size(request, monkeypatch):
    """A filter so small that nearly every row passes it, and the usual one."""
    monkeypatch.setattr(exact_dedup, "filter_words", lambda n: request.param)


def test_groups(frame, filter_size):
    data = [(i, TEXTS[i % len(TEXTS)] if i % 3 else f"alone {i}") for i in range(150)]
    data += [(7, "one"), (None, "one"), (None, "nobody"), (200, "one")]
    df = frame([(i, t, i) for i, t in data], "doc_id bigint, text string, keep_id bigint").repartition(5)
    got = exact_duplicates(df)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == plain(data)
    kept = sorted((r[0] for r in plain(data) if r[3]), key=repr)
    assert sorted((r[0] for r in without_duplicates(df).collect()), key=repr) == kept
    assert without_duplicates(df).columns == df.columns


def test_rows_that_cannot_repeat_pass_straight(frame):
    df = frame([(i, f"text {i}") for i in range(1000)] + [(2000 + i, "copy") for i in range(5)], "doc_id bigint, text string")
    passed = exact_duplicates(df).filter("may_repeat")
    assert {r.doc_id for r in passed.collect()} >= set(range(2000, 2005))
    assert passed.count() < 60


def test_empty(frame):
    df = frame([], "doc_id bigint, text string, source string")
    assert exact_duplicates(df).count() == 0
    assert without_duplicates(df).count() == 0
