import random
from collections import Counter

import zstandard
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywork.llm.compression_bands import Band, Judge, Limits, base_measures, compression_bands, repeated_words

RNG = random.Random(1)
SYLLABLES = "the of ri ver sto ne wal ks un der li ght se ven gre en a mor ning lo ud".split()
PROSE = " ".join("".join(RNG.choices(SYLLABLES, k=RNG.randrange(1, 4))) for _ in range(400))


def plain_repeats(words, window=8):
    found = Counter(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    hit = set()
    for i in range(len(words) - window + 1):
        if found[tuple(words[i : i + window])] > 1:
            hit |= set(range(i, i + window))
    return len(hit)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(0, 3))
def test_repeated_words_as_counted(words, times):
    words = words + words[:12] * times
    assert repeated_words(words) == plain_repeats(words)


def test_base_measures():
    text = "a b#\n a b#\n\n \na b#\x0bé"
    assert base_measures(text, text.encode()) == (7, 10, 3, 0, 0, True)
    text = "x y\nx y\nx y"
    assert base_measures(text, text.encode())[3] == 2


def test_bands():
    judge = Judge(Limits(bands=(Band(100, 0.0, 2.0), Band(None, 1.5, 4.0)), chunk_bytes=500))
    assert judge.verdict(b"")[2] is None
    noise = random.Random(2).randbytes(5000)
    assert judge.verdict(noise)[2] == "incompressible"
    assert judge.verdict(b"again and " * 500)[2] == "repetitive"
    prose = PROSE.encode()
    ratio, share, reason = judge.verdict(prose)
    assert reason is None and abs(ratio - len(prose) / len(zstandard.compress(prose, 3))) < 0.1
    # Noise in four tenths of the chunks; as a whole the text is still inside its band.
    mixed = judge.verdict(prose[:1500] + noise[:1000] + b"")
    assert mixed[1] > 0.3 and mixed[2] in ("bad chunks", "incompressible")


def test_edge_rows(frame, spark):
    df = frame(
        [(1, None, 0), (2, "", 1), (3, PROSE, 2), (3, PROSE, 2), (None, PROSE, 3), (5, "word " * 500000, 4)],
        "doc_id bigint, text string, kept int",
    )
    got = rows(compression_bands(df), "doc_id", "n_words", "base_failed", "kept", "reason")
    assert got.count((3, 400, False, True, None)) == 2
    assert (None, 400, False, True, None) in got
    assert (1, 0, True, False, "base") in got and (2, 0, True, False, "base") in got
    assert (5, 500000, True, False, "base") in got
    assert compression_bands(df.limit(0)).count() == 0
