import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywork.llm import source_mix
from tallywork.llm.source_mix import Mix, mix_sources, mixed_documents, sainte_lague, targets

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=7), st.integers(0, 80))
def test_highest_quotients(votes, seats):
    want = [0] * len(votes)
    if sum(votes):
        for _ in range(seats):
            best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))
            want[best] += 1
    assert sainte_lague(np.array(votes), seats).tolist() == want


def test_targets_are_reshared():
    got = targets(np.array([10.0, 1000.0, 500.0, 0.0]), np.array([5.0, 2.0, 1.0, 5.0]), 900.0, 2)
    assert got.tolist() == pytest.approx([20.0, 880 * 2 / 3, 880 / 3, 0.0])


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    data = [
        (i, " ".join(f"w{i}_{j}" for j in range(int(rng.integers(0, 300)))), "en", [None, "a", "b", "c", "hot", "hot", "hot"][i % 7], 0)
        for i in range(700)
    ]
    return spark.createDataFrame(data + [(10_000, None, "en", "empty", 0)], DOCS)


def test_targets_met_and_reruns_agree(docs):
    mix = Mix(docs_per_shard=32, block_words=16)
    first = {r.doc_id: r for r in mix_sources(docs.repartition(3), mix=mix).collect()}
    again = {r.doc_id: r for r in mix_sources(docs.repartition(8), mix=mix).collect()}
    assert first == again and len(first) == 701
    source = {r.doc_id: r.source for r in docs.collect()}
    total = sum(r.size for r in first.values())
    names = sorted({s for s in source.values() if s is not None}) + [None]
    sizes = np.array([sum(r.size for i, r in first.items() if source[i] == n) for n in names], float)
    want = targets(sizes, np.resize([5.0, 2.0, 1.0], len(names)), 1.5 * total, 2)
    for name, size, target in zip(names, sizes, want, strict=True):
        rows = [r for i, r in first.items() if source[i] == name]
        assert {r.source_size for r in rows} == {int(size)}
        assert all(r.target == pytest.approx(target) for r in rows)
        assert sum(r.taken for r in rows) == pytest.approx(target, rel=0.02, abs=16)
        assert all(0 <= r.taken <= 2 * r.size for r in rows)


def test_documents_are_cut_to_what_is_taken(docs):
    mix = Mix(docs_per_shard=32, block_words=16)
    chosen = mix_sources(docs, mix=mix)
    out = mixed_documents(docs, chosen)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        words.setdefault(r.doc_id, []).append(r.text.split())
    original = {r.doc_id: (r.text or "").split() for r in docs.collect()}
    for r in chosen.collect():
        passes = words.get(r.doc_id, [])
        assert sum(map(len, passes)) == r.taken
        for taken in passes:
            order = iter(original[r.doc_id])
            assert all(w in order for w in taken)
        for spans in r.passes:
            assert sum(spans[1::2]) - sum(spans[::2]) <= r.size


def test_empty_and_repeated(frame):
    assert mix_sources(frame([], DOCS)).count() == 0
    df = frame([(1, "a b c", "en", "s", 0, "x", 7)] * 3 + [(None, "d", "en", None, 0, "y", 8)], DOCS + ", taken string, size int")
    got = sorted((r.doc_id is None, r.size, r.source_size) for r in mix_sources(df).collect())
    assert got == [(False, 3, 9)] * 3 + [(True, 1, 1)]


def test_rows_without_ids_spread_and_reruns_agree(spark):
    """100,000 rows without an id: no shard has many more than its share; and texts of one
    length keep what is taken of them when the rows come in another order."""
    many = spark.range(100_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    mix = Mix(docs_per_shard=1000)
    shards = source_mix.in_shards(many, id="doc_id", text="text", source="source", mix=mix).groupBy("shard").count().collect()
    assert len(shards) == 100 and sum(r["count"] for r in shards) == 100_000 and max(r["count"] for r in shards) < 1300
    assert mix_sources(many, mix=mix).count() == 100_000
    few = spark.createDataFrame([(None, " ".join(f"{c}{i}" for i in range(90)), "s") for c in "abcdefgh"], "doc_id bigint, text string, source string")
    runs = [
        mix_sources(few.repartition(n, F.xxhash64("text", F.lit(n))).select("doc_id", "text", "source"), mix=Mix(block_words=30, docs_per_shard=3))
        for n in (1, 5)
    ]
    first, second = (sorted((r.size, r.taken, r.passes) for r in run.collect()) for run in runs)
    assert first == second


def test_a_very_long_text(frame):
    """One text of 300,000 words beside short ones: its size counts whole, and no row passes twice its size."""
    df = frame([(1, "word " * 300_000, "en", "s", 0), (2, "a b", "en", "s", 0), (3, "c", "en", "t", 0)], DOCS)
    got = {r.doc_id: r for r in mix_sources(df).collect()}
    assert got[1].size == 300_000 and all(r.taken <= 2 * r.size for r in got.values())
    assert abs(sum(r.taken for r in got.values()) - 1.5 * 300_003) < 200


def test_no_source_is_above_its_cap():
    """Rounding gives the capped first source no block beyond twice its own."""
    size = np.array([54179, 14323, 18935, 9127, 18610, 49851])
    layout = pd.DataFrame({"source": list("abcdef"), "source_size": size, "blocks": np.round(size / 64).astype(int)})
    plan = source_mix._source_plan(Mix())(layout)
    quota, blocks = plan["quota"].to_numpy(), layout["blocks"].to_numpy()
    assert quota[0] == 2 * blocks[0] == 1694 and (quota <= 2 * blocks).all()
    assert quota.sum() == round((plan["target"] * blocks / size).sum())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20)), min_size=1, max_size=7), st.integers(0, 80))
def test_highest_quotients_below_caps(sources, seats):
    votes, caps = (np.array(x) for x in zip(*sources, strict=True))
    want = [0] * len(votes)
    for _ in range(seats):
        free = [i for i in range(len(votes)) if votes[i] and want[i] < caps[i]]
        if free:
            want[max(free, key=lambda i: (votes[i] / (2 * want[i] + 1), -i))] += 1
    assert source_mix.capped_seats(votes, seats, caps).tolist() == want
