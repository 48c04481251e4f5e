import itertools

import pyarrow.parquet as pq
import pytest
import sentencepiece
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywork.llm.piece_transducer import MODEL, Transducer, Vocabulary, decode_ids, encode_and_decode, encode_texts, read_vocabulary


@pytest.fixture(scope="module")
def machine():
    return Transducer(read_vocabulary())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


ODD = [
    "", " ", "  a b  ", "x\n\té\U0001f600 \x00", "日本語 のテキスト ", "▁ a▁b", "a" * 300, " " * 40 + "x" + " " * 7, "ﬁ Ω≈ç√ Привет мир",
    "    def f(x):\n        return x**2\n", "1234567890 3.14159 http://www.example.com/a?b=c&d=e", "aaaaabbbbbaaaa", "\r\n\r\n", "ᄀ가각힣", "-----=====",
]


def test_ids_are_those_of_the_library(machine, library):
    texts = ODD + pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    for text in texts:
        ids = machine.encode(text)
        assert ids == library.encode(text), text[:80]
        assert machine.decode(ids) == library.decode(ids)
        assert "▁" in text or machine.decode(ids) == text


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="aeinorst hl.,'▁\n", max_size=40), st.text(alphabet=" \tab", max_size=30)))
def test_any_text(machine, library, text):
    assert machine.encode(text) == library.encode(text)


def test_neighbours(machine):
    """A pair may stand side by side exactly when the merges leave it so."""
    pieces = [p for _, p, _ in machine.vocabulary.pieces][: 4000 : 37]
    for a, b in itertools.islice(itertools.product(pieces, pieces), 0, None, 7):
        left, right, whole = machine.spines(a + b)
        parts = [a, b]
        apart = not whole and machine.follows("", a) and machine.follows("", b) and left[-1][0] == a and right[-1][0] == b
        assert machine.follows(a, b) == apart, parts


def brute(vocabulary, text):
    """The least total weight over all ways to cut the text."""
    scores = {p: s for _, p, s in vocabulary.pieces}
    worst = 10.0 - min(scores.values())
    best = [0.0] + [float("inf")] * len(text)
    for end in range(1, len(text) + 1):
        for at in range(end):
            part = text[at:end]
            cost = -scores[part] if part in scores else worst if len(part) == 1 else float("inf")
            best[end] = min(best[end], best[at] + cost)
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.text(alphabet="ab▁", min_size=1, max_size=4), st.integers(-9, -1), min_size=1, max_size=12),
    st.text(alphabet="abc ", max_size=14),
    st.booleans(),
)
def test_unigram_shortest_path(pieces, text, bytes_):
    vocabulary = Vocabulary(
        tuple((300 + i, p, float(s)) for i, (p, s) in enumerate(pieces.items())), tuple(range(256)) if bytes_ else (), 999, False, True
    )
    machine = Transducer(vocabulary)
    path = [p for part in (machine.cut.findall(machine.normalised(text)) if machine.cut else [machine.normalised(text)]) for p in machine.shortest(part)]
    assert "".join(path) == machine.normalised(text)
    assert sum(map(machine.weight, path)) == pytest.approx(brute(vocabulary, machine.normalised(text)))
    if bytes_:
        assert machine.decode(machine.encode(text)) == text


def test_rows(spark, frame, library):
    vocabulary = read_vocabulary()
    long = "long text " * 100_000
    df = frame([(1, "Hello world", 0), (1, "Hello world", 0), (None, None, 1), (2, "", 1), (3, "a▁", 1), (4, long, 1)], "doc_id bigint, text string, ids int")
    out = {(r.doc_id, r.n_pieces, r.round_trip) for r in encode_and_decode(df, vocabulary).collect()}
    assert out == {(1, 2, True), (None, 0, True), (2, 0, True), (3, len(library.encode("a▁")), False), (4, len(library.encode(long)), True)}
    encoded = encode_texts(df, vocabulary)
    assert rows(decode_ids(encoded.filter("doc_id < 3"), vocabulary)) == [(1, "Hello world"), (1, "Hello world"), (2, "")]
    assert encode_and_decode(df.limit(0), vocabulary).count() == 0
