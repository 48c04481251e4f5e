"""Centroid clustering with candidates filtered by n-simplex projection.

Vectors are made integers, so every distance and every mean is exact. Some of the first
centroids serve as pivots. The distances of a vector to the pivots, measured once, place it
as the apex of a simplex whose base the pivots span: coordinates in the base, and a height
over it. For two apexes the distance with both heights on one side of the base is a lower
bound of the distance of the vectors, with the heights on opposite sides an upper bound.
A round compares a vector exactly only with those centroids whose lower bound does not
exceed the least upper bound.

Integers and apexes are written once; every round reads them, sums each cluster inside its
tasks, and gives the driver one row per cluster and component. Only centroids and the base
are sent to tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.text import slices
from tallywork.session import written

# Below this magnitude squares of differences, summed over any usual number of components,
# fit 64 bits; larger ones are computed with Python's integers.
NARROW = 1 << 26
WIDEST = 1 << 62
LARGEST = (1 << 63) - 1


class Settings(NamedTuple):
    """The defaults are those of the registered query."""

    size: int = 64
    clusters: int = 40
    rounds: int = 5
    scale: int = 256
    seed: str = "2:"
    pivots: int = 12


SCHEMA = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def _narrow(*arrays: np.ndarray) -> bool:
    return all(not a.size or (a.max() <= NARROW and a.min() >= -NARROW) for a in arrays)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two equally shaped arrays of integers."""
    if not _narrow(a, b):
        a, b = a.astype(object), b.astype(object)
    return ((a - b) ** 2).sum(axis=-1)


class Base:
    """The simplex of the pivots; the first of them is the origin.

    Row i of ``corners`` holds the coordinates of pivot i + 1, zero beyond component i.
    """

    # A pivot nearly inside the span of the others would only add rounding errors.
    WORST_CONDITION = 1e4

    def __init__(self, points: np.ndarray, most: int):
        """Pivots from ``points`` (at least one row of integers), the highest apex first."""
        chosen = [0]
        self._take(points[chosen])
        while len(chosen) < most:
            heights = self.apexes(points)[:, -1]
            best = int(np.argmax(heights))
            if not heights[best] > 0 or best in chosen:
                break
            before = self.pivots, self.corners, self.norms
            self._take(points[[*chosen, best]])
            if not np.linalg.cond(self.corners) < self.WORST_CONDITION:
                self.pivots, self.corners, self.norms = before
                break
            chosen.append(best)

    def _take(self, pivots: np.ndarray) -> None:
        self.pivots = pivots
        n = len(pivots)
        between = np.array([[float(squared(a, b)) for b in pivots] for a in pivots])
        products = (between[1:, :1] + between[:1, 1:] - between[1:, 1:]) / 2
        self.corners = np.zeros((n - 1, n - 1))
        for i in range(n - 1):
            row = self.corners[i]
            for j in range(i):
                row[j] = (products[i, j] - row[:j] @ self.corners[j, :j]) / self.corners[j, j]
            row[i] = np.sqrt(max(products[i, i] - row[:i] @ row[:i], 0.0))
        self.norms = between[0, 1:]

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Apex coordinates of rows of integers: as many as there are pivots, the height last."""
        to = np.stack([squared(x, p[None, :]) for p in self.pivots], axis=1).astype(float)
        products = (to[:, :1] + self.norms - to[:, 1:]) / 2
        inside = np.linalg.solve(self.corners, products.T).T if len(self.norms) else products
        height = np.sqrt(np.maximum(to[:, 0] - (inside**2).sum(axis=1), 0.0))
        return np.column_stack([inside, height])


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between all of ``a`` and all of ``b``, apexes."""
    inside = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    ours, theirs = a[:, -1:], b[None, :, -1]
    return np.sqrt(inside + (ours - theirs) ** 2), np.sqrt(inside + (ours + theirs) ** 2)


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, their: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: number of the nearest centroid (ties: the smaller), squared distance, and
    how many centroids were compared exactly."""
    lower, upper = bounds(apexes, their)
    # Room for rounding, far above the error of a well-conditioned base and far below one
    # unit of distance for all but enormous components.
    room = 1e-7 * (1 + upper.max(axis=1, initial=0.0))
    possible = ~(lower > (upper.min(axis=1) + room)[:, None])
    best = np.zeros(len(x), np.int32)
    least = np.full(len(x), LARGEST) if _narrow(x, centroids) else np.full(len(x), float("inf"), object)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(possible[:, number])
        exact = squared(x[rows], centroid[None, :])
        # Only a smaller distance takes a row over, so of equal ones the smaller number stays.
        nearer = (exact < least[rows]).astype(bool)
        least[rows[nearer]], best[rows[nearer]] = exact[nearer], number
    return best, least, possible.sum(axis=1, dtype=np.int32)


def _matrix(column: pa.Array, size: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, size)


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def usable(vectors: DataFrame, id: str, vector: str, settings: Settings) -> DataFrame:
    """(vec_id, v): the vectors of the right size whose components are all there, finite and,
    scaled, within 2^62."""
    inside = F.lit(float(WIDEST) / settings.scale)
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inside))
    picked = vectors.select(F.col(id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return picked.filter(F.col("v").isNotNull() & (F.size("v") == settings.size)).filter(good)


def _integers(v: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(v * scale).astype(np.int64)


def _first_centroids(kept: DataFrame, settings: Settings) -> np.ndarray:
    by = F.sha2(F.concat(F.lit(settings.seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.withColumn("_by", by).orderBy("_by", "v").limit(settings.clusters).select("v").collect()
    return _integers(np.array([r["v"] for r in first], float).reshape(-1, settings.size), settings.scale)


def _projected(kept: DataFrame, base: Base, settings: Settings) -> DataFrame:
    """(vec_id, x, apex): integers and apex coordinates, written once."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            x = _integers(_matrix(batch.column(1), settings.size, float), settings.scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(x), _lists(base.apexes(x))], names=["vec_id", "x", "apex"]
            )

    return written(kept.mapInArrow(project, "vec_id bigint, x array<bigint>, apex array<double>"))


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, their: np.ndarray):
    for batch in slices(batches, 512):
        if batch.num_rows:
            x = _matrix(batch.column(1), centroids.shape[1], np.int64)
            apexes = _matrix(batch.column(2), their.shape[1], float)
            yield batch.column(0), x, *nearest(x, apexes, centroids, their)


def _moved(projected: DataFrame, centroids: np.ndarray, base: Base) -> np.ndarray:
    """Centroids after one round: exact floors of the means, empty clusters unmoved."""
    their, (k, size) = base.apexes(centroids), centroids.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, size + 1), object)
        for _, x, cluster, _, _ in _assigned(batches, centroids, their):
            for j in np.unique(cluster):
                mine = x[cluster == j]
                part = mine.sum(axis=0) if _narrow(mine) else mine.astype(object).sum(axis=0)
                sums[j, :size] += part.astype(object)
                sums[j, size] += len(mine)
        at = [(j, i) for j in range(k) if sums[j, size] for i in range(size + 1)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([j for j, _ in at], pa.int32()),
                pa.array([i for _, i in at], pa.int32()),
                pa.array([str(sums[p]) for p in at], pa.string()),
            ],
            names=["j", "i", "total"],
        )

    parts = projected.mapInArrow(totals, "j int, i int, total string")
    # At most clusters x (size + 1) rows, whatever the number of vectors.
    found = parts.groupBy("j", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r["j"], r["i"]): int(r["total"]) for r in found}
    moved = centroids.copy()
    for j in range(k):
        if total.get((j, size)):
            moved[j] = [total[j, i] // total[j, size] for i in range(size)]
    return moved


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256 and compared (centroids that the bounds left to compare exactly).

    A vector is usable if it has exactly ``size`` components, none null, not finite or, times
    ``scale``, of 2^62 or more. Components become floor(scale * x). The first centroids
    are the vectors with the least SHA-256 of ``seed`` and id (a null id counts as empty text;
    equal ids by components); fewer vectors make fewer clusters, none an empty result. Equal
    distances go to the smaller number; equal vectors and repeated ids are rows of their own.
    Distances and sums beyond 64 bits are given as 2^63 - 1. Other columns are not read.
    Starts jobs when the plan is built: a round each.
    """
    spark = vectors.sparkSession
    kept = usable(vectors, id, vector, settings)
    centroids = _first_centroids(kept, settings)
    if not len(centroids):
        return spark.createDataFrame([], f"{SCHEMA}, compared int")
    base = Base(centroids, settings.pivots)
    projected = _projected(kept, base, settings)
    for _ in range(settings.rounds):
        centroids = _moved(projected, centroids, base)
    their = base.apexes(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance, compared in _assigned(batches, centroids, their):
            capped = pa.array([min(int(d), LARGEST) for d in distance], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster), capped, pa.array(compared)],
                names=["vec_id", "cluster", "distance", "compared"],
            )

    rows = written(projected.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint, compared int"))
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    inertia = min(sum(int(r["total"]) for r in sums), LARGEST)
    known = [(r["cluster"], min(int(r["total"]), LARGEST), inertia, digest(centroids[r["cluster"]])) for r in sums]
    clusters = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    columns = [part.split()[0] for part in SCHEMA.split(", ")]
    # One row per cluster: bounded by ``clusters``.
    return rows.join(F.broadcast(clusters), "cluster").select(*columns, "compared")


def _sql(settings: Settings) -> str:
    """The same clustering as one query: a set of expressions for each round, nothing filtered."""
    near = (
        "SELECT vec_id, x, arg_min(j, (d, j)) AS j, min(d) AS d FROM (SELECT v.vec_id, v.x, c.j, "
        "list_sum(list_transform(v.x, lambda a, i: (a - c.c[i]) * (a - c.c[i])))::BIGINT AS d FROM v CROSS JOIN c{0} c) "
        "GROUP BY vec_id, x"
    )
    steps = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor({settings.scale} * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {settings.size}
    AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(coalesce(e, 0)))))""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS j, x AS c
  FROM (SELECT x, sha256('{settings.seed}' || vec_id) AS h FROM v ORDER BY h LIMIT {settings.clusters}))""",
    ]
    for r in range(settings.rounds):
        steps += [
            f"n{r} AS MATERIALIZED ({near.format(r)})",
            f"""m{r} AS MATERIALIZED (
  SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS c
  FROM (SELECT j, i, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n
        FROM (SELECT j, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM n{r}) GROUP BY j, i) GROUP BY j)""",
            f"c{r + 1} AS MATERIALIZED (SELECT j, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN m{r} m USING (j))",
        ]
    r = settings.rounds
    return f"""WITH {', '.join(steps)},
last AS MATERIALIZED ({near.format(r)})
SELECT l.vec_id, l.j::INTEGER AS cluster, l.d AS distance, (sum(l.d) OVER (PARTITION BY l.j))::BIGINT AS cluster_inertia,
       (sum(l.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM last l JOIN c{r} c USING (j)"""


SQL = _sql(Settings())
