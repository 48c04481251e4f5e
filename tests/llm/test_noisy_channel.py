import random
import zlib

import numpy as np
import pytest
from conftest import rows

from tallywork.llm import noisy_channel as channel
from tallywork.llm.noisy_channel import BOUNDARY, CELLS, SYMBOLS, Decoder, Fit, Scorer, gram_counts, log_probabilities, token_words

DOCS = "doc_id bigint, text string, score string"
BAD = ["idiot", "moron", "stupid", "worthless"]


def corpus(n=700):
    rng = random.Random(5)
    words = "the of river stone walks under light seven green morning people house water little summer winter garden letter".split()
    docs, labels = [], []
    for i in range(n):
        text, y = [rng.choice(words) + rng.choice(["", "s", "er"]) for _ in range(rng.randrange(5, 60))], int(i % 6 == 0)
        for _ in range(2 * y):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        docs.append((i, " ".join(text), "x"))
        labels.append((i, y))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    return channel.train(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_grams():
    counts = gram_counts(["Ab  é", "b"])
    code = lambda *s: sum(x * SYMBOLS ** (3 - i) for i, x in enumerate(s))
    want = np.zeros(CELLS, int)
    for gram in [(0, 0, 0, 1), (0, 0, 1, 2), (0, 1, 2, 0), (1, 2, 0, 0), (2, 0, 0, 0), (0, 0, 0, 5), (0, 0, 5, 0), (0, 5, 0, 0), (5, 0, 0, 0), (0, 0, 0, 2), (0, 0, 2, 0), (0, 2, 0, 0), (2, 0, 0, 0)]:
        want[code(*gram)] += 1
    assert counts.tolist() == want.tolist()


def test_probabilities_add_up():
    seen = np.array([5, 700, CELLS - 1])
    p = np.exp(log_probabilities(seen, np.array([3.0, 9.0, 1.0])).reshape(-1, SYMBOLS))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def plain_decode(decoder, token):
    """Every reading, scored in full."""
    found = [(0.0, "")]
    for options in decoder.readings(token):
        found = [(s - c, t + part) for s, t in found for part, c in options]

    def total(cost, text):
        state = BOUNDARY
        for char in text:
            code = state * SYMBOLS + int(channel.fold()[ord(char)])
            cost, state = cost + float(decoder.log_p[code]), code % SYMBOLS**3
        return cost + float(decoder.log_p[state * SYMBOLS])

    return max(total(s, t) for s, t in found), {t for s, t in found if total(s, t) >= max(total(a, b) for a, b in found) - 1e-4}


@pytest.mark.parametrize("token", ["1d10t", "m0r0n", "stuuupid", "$tup1d", "w0rthl3$s", "m.o.r.o.n", "11ght", "a", "st@@r", "4+1"])
def test_viterbi_finds_the_best_reading(model, token):
    decoder = Decoder(model.log_p)
    assert decoder.restored(token) in plain_decode(decoder, token)[1]


@pytest.mark.parametrize("token, word", [("1d10t", "idiot"), ("m0r0n", "moron"), ("stuuupid", "stupid"), ("$tup1d", "stupid"), ("m.o.r.o.n", "moron"), ("moron###", "moron"), ("(m0ron!)", "moron"), ("garden", "garden")])
def test_restored_words(model, token, word):
    assert word in token_words(token, Decoder(model.log_p))


def test_spaced_letters(model):
    scorer = Scorer(Decoder(model.log_p), model.weights)
    assert scorer.evidence("you m o r o n there").largest > 0
    assert scorer.evidence("a b").hits == 0
    assert scorer.evidence("x " * 3000 + "moron").hits == 1


def test_held_out_accuracy(spark, model):
    docs, labels = corpus()
    truth = dict(labels)
    out = channel.score(spark.createDataFrame(docs, DOCS), model).collect()
    assert {r.held_out for r in out} == {True, False}
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [r for r in out if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.98 * len(unseen)
    disguised = spark.createDataFrame([(1, "the little garden of a m0r0n and 1d10t", ""), (2, "the little garden of water", ""), (3, "you s t u p i d stuuupid people", "")], DOCS)
    assert rows(channel.score(disguised, model), "doc_id", "predicted") == [(1, 1), (2, 0), (3, 1)]


def test_held_out_labels_are_not_learned(spark):
    """Labels of held-out rows turned around change nothing."""
    docs, labels = corpus(240)
    df = spark.createDataFrame(docs, DOCS)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    one, other = (channel.train(df, spark.createDataFrame(x, "doc_id bigint, toxic int")) for x in (labels, turned))
    assert one.weights == other.weights and np.array_equal(one.beta, other.beta)


def test_edge_rows(spark, frame, model):
    df = frame([(1, None, "a"), (None, "", "b"), (2, "moron", "c"), (2, "moron", "c"), (3, "moron " * 200_000, "d")], DOCS)
    got = rows(channel.score(df, model), "doc_id", "held_out", "predicted")
    assert len(got) == 5 and (None, False, 0) in got and got.count((2, False, 1)) + got.count((2, True, 1)) == 2
    assert rows(channel.without_toxic(df, model), *df.columns) == [(1, None, "a"), (None, "", "b")]
    nothing = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in channel.toxicity(df, nothing).collect()} == {0.0}
    assert channel.toxicity(df.limit(0), nothing).count() == 0
    one_kind = spark.createDataFrame([(2, 0), (3, 0), (2, None)], "doc_id bigint, toxic int")
    assert {r.predicted for r in channel.toxicity(df, one_kind, fit=Fit(fit_rows=1)).collect()} == {0}


LONG_RUN = "t h e r i v e r s t o n e " * 7


@pytest.mark.parametrize("text", ["st" + "u" * 70 + "pid", "m.o.r.o.n." * 12 + "m.o.r.o.n", "i d ! o t", "m  o\tr \n o n", LONG_RUN + "w o r t h l e s s " + LONG_RUN, "x" * 61 + " s t u p 1 d"])
def test_disguises_of_any_length_and_spacing(model, text):
    assert Scorer(Decoder(model.log_p), model.weights).evidence(f"you {text}").largest > 0


def test_long_tokens_cost_no_more_than_their_length(model):
    """Settled prefixes leave the best reading; what looks disguised is found without backtracking."""
    decoder = Decoder(model.log_p)
    for token in ("m0r0nst@@r" * 40, "1d10tl1ght" * 40):
        one = decoder.restored(token)
        channel.SETTLED, held = 1 << 30, channel.SETTLED
        try:
            assert decoder.restored(token) == one
        finally:
            channel.SETTLED = held
    assert len(decoder.restored("m0r0n" * 20_000)) >= 80_000
    assert not channel.disguised("ab" * 500_000) and token_words("ab" * 500_000, decoder) == ["ab" * 500_000]


def test_disguised_tokens(model):
    rng = random.Random(8)
    old = channel.re.compile(r"[^\W_].*[\d@$!|+(¢€£*]|[\d@$!|+(¢€£*].*[^\W\d_]|([^\W\d_])\1\1|^(?:[^\W\d_][._\-~]){2,}[^\W\d_]$")
    for _ in range(5000):
        token = "".join(rng.choice("abé1$._") for _ in range(rng.randrange(1, 8)))
        assert channel.disguised(token) == bool(old.search(token)), token


def test_texts_that_open_alike_are_all_learned_from(spark):
    """A header of 100 characters in common costs no labelled row; copies of whole texts do."""
    docs, labels = corpus(300)
    header = "the river stone walks under light " * 3
    docs = [(i, header + text, s) for i, text, s in docs] + [(i + 1000, (header + text).upper(), s) for i, text, s in docs]
    labels += [(i + 1000, y) for i, y in labels]
    df, labelled = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    sample = channel.labelled_sample(df, labelled, Fit(), "doc_id", "text", "toxic").collect()
    seen = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len(sample) == len({i % 1000 for i in seen}) and {r.fold for r in sample} == {0, 1}
    assert sum(r.y for r in sample) == sum(y for i, y in labels[:300] if i in seen or i + 1000 in seen)


def caught(spark, docs, labels, fit=Fit()):
    """Held-out toxic rows caught, and clean ones flagged."""
    df, truth = spark.createDataFrame(docs, DOCS), dict(labels)
    out = channel.toxicity(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"), fit=fit).filter("held_out").collect()
    return tuple(sum(r.predicted for r in out if truth[r.doc_id] == y) for y in (1, 0))


def test_a_common_header_changes_no_verdict(spark):
    """Texts that all open with the same 100 characters and more are scored as without them."""
    docs, labels = corpus()
    header = "the river stone walks under light seven green morning " * 3
    plain = caught(spark, docs, labels)
    assert plain[0] > 20 and caught(spark, [(i, header + t, s) for i, t, s in docs], labels) == plain


def test_a_fold_without_a_label_is_scored_by_all_weights(spark):
    """All labelled texts of one kind in one fold: the scores still tell the labels apart."""
    import hashlib

    docs, labels = corpus(1500)
    truth, fold_of = dict(labels), {}
    copies = spark.createDataFrame([(hashlib.sha256(t.lower().encode()).hexdigest(), i) for i, t, _ in docs], "c string, i bigint")
    for r in copies.selectExpr("i", "pmod(xxhash64(c), 2) AS f").collect():
        fold_of[r.i] = r.f
    kept = [d for d in docs if truth[d[0]] == 0 or fold_of[d[0]] == 0]
    found = caught(spark, kept, [(i, y) for i, y in labels if y == 0 or fold_of[i] == 0])
    held = [d for d in kept if truth[d[0]] and zlib.crc32(str(d[0]).encode()) % 4 == 2]
    assert found[0] >= 0.9 * len(held) > 10 and found[1] <= 20


def test_features_are_chosen_by_association(spark):
    """A rare word of toxic texts alone does not push out one that is frequent in them."""
    counted = spark.createDataFrame(
        [("", 500, 50, 500, 50), ("sure", 5, 40, 5, 40), ("rare", 0, 2, 0, 2), ("weak", 0, 3, 1, 1), ("clean", 90, 3, 90, 3)],
        "feature string, n00 long, n01 long, n10 long, n11 long",
    )
    best = [r.feature for r in channel.strongest_features(counted, [500, 50, 500, 50], Fit(max_features=2)).collect()]
    assert best == ["sure", "rare"]
