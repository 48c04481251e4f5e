import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywork.llm import simhash_dedup
from tallywork.llm.simhash_dedup import BKTree, components, fingerprint, near_duplicates, near_links, without_near_duplicates


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Ids and fingerprints to the smallest id reachable over links of at most two bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (id_, _) in enumerate(prints):
        r = find(i)
        least[r] = min(x for x in (least.get(r), id_) if x is not None) if least.get(r) is not None or id_ is not None else None
    return [least[find(i)] for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", "One", "one Two", "one two three", "a b c d e f a b c", "É b C d"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4095), unique=True, min_size=1, max_size=60), st.integers(0, 3), st.integers(0, 4095))
def test_tree_finds_all_within(values, radius, query):
    tree = BKTree()
    for v in values:
        tree.add(v)
    found = {tree.values[n] for n in tree.within(query, radius)}
    assert found == {v for v in values if (v ^ query).bit_count() <= radius}


@pytest.mark.parametrize("tree_size", [2048, 16, 1])
def test_links_connect_all_neighbours(spark, tree_size, monkeypatch):
    """Chains, a dense cluster and noise; with small trees the cluster's shards are split."""
    monkeypatch.setattr(simhash_dedup, "TREE_SIZE", tree_size)
    rng = random.Random(4)
    base = rng.getrandbits(64)
    values = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    chain = rng.getrandbits(64)
    for _ in range(40):
        chain ^= 1 << rng.randrange(64)
        values.add(chain)
    values |= {rng.getrandbits(64) for _ in range(200)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(4)
    got = {r.node: r.root for r in components(near_links(df)).collect()}
    got = {v: got.get(v, v) for v in signed}
    prints = [(v, v & (1 << 64) - 1) for v in signed]
    want = dict(zip(signed, plain_components(prints), strict=True))
    assert got == want


def test_a_crowded_shard_is_dealt_in_proportion(spark, monkeypatch):
    """All fingerprints share 32 bits, some of them 48: rows grow with their number, trees stay
    small, and all neighbours still meet."""
    monkeypatch.setattr(simhash_dedup, "TREE_SIZE", 100)
    rng = random.Random(8)

    def rows_of(n):
        values = [rng.getrandbits(32) for _ in range(n)] + [rng.getrandbits(16) for _ in range(n // 4)]
        values += [v ^ 1 << rng.randrange(32) ^ 1 << rng.randrange(32) for v in values[: n // 10]]
        values = sorted(set(values))
        df = spark.createDataFrame([(v,) for v in values], "fp bigint").repartition(4)
        dealt_rows, count = simhash_dedup.shards(df)
        sizes = dealt_rows.groupBy("choice", "bits").count()
        assert dealt_rows.count() == count and sizes.agg({"count": "max"}).first()[0] <= 256
        return values, df, count

    values, df, count = rows_of(1000)
    more, _, count_of_more = rows_of(4000)
    assert count <= 60 * len(values) and count_of_more <= 60 * len(more)
    got = {r.node: r.root for r in components(near_links(df)).collect()}
    want = plain_components([(v, v) for v in values])
    assert [got.get(v, v) for v in values] == want and len(set(want)) < len(values) - 100


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1200)}


def test_documents(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    data = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randrange(200))]
        data.append((i, " ".join(text)))
        if text and i % 3 == 0:
            text[rng.randrange(len(text))] = "changed"
            data.append((1000 + i, " ".join(text)))
    data += [(2000, None), (2001, ""), (2002, " \n"), (None, "lonely words here"), (None, data[5][1]), (2003, data[5][1]), (5, data[5][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id bigint, text string, component_id string").repartition(5)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(df).collect()), key=repr)
    prints = [(i, plain_fingerprint(t)) for i, t in data]
    want = sorted(((i, f"{fp:016x}", c) for (i, fp), c in zip(prints, plain_components(prints), strict=True)), key=repr)
    assert got == want
    kept = without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(i) for i, _, c in want if i is None or i == c)


def test_empty(frame):
    assert near_duplicates(frame([], "doc_id bigint, text string")).count() == 0
