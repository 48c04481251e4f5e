"""The clustering against a plain version, and the bounds against exact distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from tallywork.llm.simplex_clustering import Base, Settings, bounds, cluster_vectors, nearest, squared

SMALL = Settings(size=4, clusters=5, rounds=3, pivots=4)
SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance int"


def plain(data, settings):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) of every usable vector."""
    usable = lambda v: v is not None and len(v) == settings.size and all(c is not None and math.isfinite(c) for c in v)
    rows = [(i, [math.floor(settings.scale * c) for c in v]) for i, v in data if usable(v)]
    by = lambda r: (hashlib.sha256(f"{settings.seed}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(rows, key=by)[: settings.clusters]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((apart(v, c), j) for j, c in enumerate(centroids))
    for _ in range(settings.rounds):
        mine = [near(v)[1] for _, v in rows]
        for j in range(len(centroids)):
            held = [v for (_, v), k in zip(rows, mine, strict=True) if k == j]
            if held:
                centroids[j] = [sum(c) // len(held) for c in zip(*held, strict=True)]
    last = [(i, *near(v)[::-1]) for i, v in rows]
    of = {j: sum(d for _, k, d in last if k == j) for j in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, of[j], sum(of.values()), digest[j]) for i, j, d in last), key=repr)


def found(df):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("pivots", [1, 2, 4, 9])
def test_equals_plain(spark, pivots):
    rng = random.Random(pivots)
    data = [(i, [rng.gauss(3 * (i % 4), 0.3) for _ in range(4)]) for i in range(150)]
    data += [(200 + i, data[i][1]) for i in range(20)] + [data[3], data[3], (None, data[7][1]), (None, [0.0] * 4)]
    data += [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0, None, 1.0, 1.0]), (304, [1.0, float("nan"), 1.0, 1.0])]
    data += [(305, [float("inf"), 0.0, 0.0, 0.0]), (306, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in data], SCHEMA).repartition(5)
    settings = SMALL._replace(pivots=pivots)
    assert found(cluster_vectors(df, settings=settings)) == plain(data, settings)


def test_clusters_apart_are_told_without_comparing(spark):
    rng = random.Random(1)
    data = [(i, [rng.gauss(40 * (i % 5), 0.3), *(rng.gauss(0, 0.3) for _ in range(3))]) for i in range(300)]
    out = cluster_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), settings=SMALL).collect()
    assert sum(r["compared"] for r in out) < 3 * len(out)


def test_wide_components(spark):
    rng = random.Random(2)
    data = [(i, [rng.uniform(-1, 1) * 2.0**40 for _ in range(4)]) for i in range(40)]
    got = found(cluster_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), settings=SMALL))
    most = (1 << 63) - 1
    assert got == sorted(((i, j, *(min(x, most) for x in sums), h) for i, j, *sums, h in plain(data, SMALL)), key=repr)


def test_fewer_vectors_than_clusters_and_none(spark):
    data = [(7, [1.0, 2.0, 3.0, 4.0]), (8, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    assert found(cluster_vectors(df, settings=SMALL)) == plain(data, SMALL)
    assert cluster_vectors(df.limit(0), settings=SMALL).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x, c = rng.integers(-200, 200, (300, 16)), rng.integers(-200, 200, (12, 16))
    c[5] = c[4]
    for pivots in (1, 3, 12):
        base = Base(c, pivots)
        lower, upper = bounds(base.apexes(x), base.apexes(c))
        exact = np.sqrt(((x[:, None] - c[None]) ** 2).sum(axis=2))
        assert (lower <= exact + 1e-6).all() and (upper >= exact - 1e-6).all()
        number, distance, _ = nearest(x, base.apexes(x), c, base.apexes(c))
        assert (number == exact.argmin(axis=1)).all() and (distance == squared(x, c[number])).all()
