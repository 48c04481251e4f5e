"""SimHash near-duplicates by BK-trees.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles.
Fingerprints at most ``radius`` bits apart are linked; documents linked directly or
through others form a component.

Two fingerprints within 2 bits agree on at least two of their four 16-bit blocks, so
each fingerprint is dealt to the six shards named by a pair of its blocks and meets all
its neighbours there. A shard's fingerprints form a BK-tree: a child hangs at the integer
Hamming distance to its parent, and a search follows only the edges whose distance lies
within the radius of its own. Trees are built and searched where their shard is, not broadcast:
all of them together grow with the corpus.

A shard with more members than a tree may have is dealt again in the same way, by pairs of the
four 8-bit blocks of the 32 bits its members need not share, and then by 4-bit blocks of the
16 bits left. After that the members share 56 bits, so there are 256 at most. A fingerprint
has at most 6, 36 or 216 rows, however many lie in its shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.keys import lookup
from tallywork.llm.cut import cut
from tallywork.llm.text import LOWER_BYTES, dealt, slices, tasks_for

SHINGLE, SEED, RADIUS = 3, 42, 2
BLOCKS = 4
# Bits of a block of all 64 bits, and of the 32 and 16 that members of a shard need not share.
BLOCK_BITS = (16, 8, 4)
PAIRS = tuple(combinations(range(BLOCKS), 2))
TREE_SIZE = 2048
# Rows (a fingerprint in one of its shards) a task holds.
TASK_ROWS = 500_000


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text; 0 where it has no words."""
    words = raw.translate(LOWER_BYTES).split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hash_, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [hash_(join(t), SEED) for t in zip(*(words[i:] for i in range(shingle)))]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): one row per row of ``docs``; fp is the fingerprint as a signed 64-bit number."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint((t or "").encode(), shingle) for t in batch.column(1).to_pylist()]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["id", "fp"])

    return docs.select(F.col(id).cast("bigint"), F.col(text).cast("string")).mapInArrow(prints, "id bigint, fp bigint")


class BKTree:
    """Distinct fingerprints; the children of a node are keyed by their distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        node, new = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        while new:
            distance = (self.values[node] ^ value).bit_count()
            nxt = self.children[node].setdefault(distance, new)
            if nxt == new:
                return
            node = nxt

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes at most ``radius`` from ``value``."""
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            children = self.children[node]
            if len(children) <= 2 * radius + 1:
                todo += [c for d, c in children.items() if abs(d - distance) <= radius]
            else:
                todo += [c for d in range(distance - radius, distance + radius + 1) if (c := children.get(d)) is not None]
        return found


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Links found by searching the tree of ``members`` for each of them, reduced to one row
    per fingerprint: itself and the smallest one it is connected with here."""
    tree, parent = BKTree(), {}
    for value in members:
        tree.add(value)

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in members:
        for node in tree.within(value, radius):
            a, b = root(value), root(tree.values[node])
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(x, r) for x in parent if (r := root(x)) != x]


def _links(radius: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shuffled rows (choice, bits, fp) of a whole partition to links (a, b)."""
        held = [np.stack([c.to_numpy() for c in b.columns]) for b in batches if b.num_rows]
        if not held:
            return
        choice, bits, fp = np.concatenate(held, axis=1)
        order = np.lexsort((fp, bits, choice))
        choice, bits, fp = choice[order], bits[order], fp[order]
        change = np.flatnonzero((np.diff(choice) != 0) | (np.diff(bits) != 0)) + 1
        starts = np.concatenate([[0], change])
        ends = np.concatenate([change, [len(fp)]])
        out: list[tuple[int, int]] = []
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
            out += shard_links(fp[a:b].view(np.uint64).tolist(), radius)
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return links


def _dealt_by_pairs(rows: DataFrame, width: int) -> DataFrame:
    """Six rows for each of ``rows`` (fp, choice, bits, rest): a shard is which blocks were
    chosen so far and what they hold; ``rest`` is the bits of no chosen block."""

    def block(i: int) -> Column:
        return F.shiftrightunsigned("rest", width * i).bitwiseAND(F.lit((1 << width) - 1))

    def joined(*parts: Column) -> Column:
        return reduce(lambda high, low: F.shiftleft(high, width).bitwiseOR(low), parts)

    shards = []
    for n, (i, j) in enumerate(PAIRS):
        p, q = (x for x in range(BLOCKS) if x not in (i, j))
        choice = F.col("choice") * len(PAIRS) + (len(PAIRS) + n)
        bits = joined(F.col("bits"), block(i), block(j))
        shards.append(F.struct(choice.alias("choice"), bits.alias("bits"), joined(block(p), block(q)).alias("rest")))
    return rows.select("fp", F.explode(F.array(*shards)).alias("_shard")).select("fp", "_shard.*")


def shards(distinct: DataFrame) -> tuple[DataFrame, int]:
    """Rows (choice, bits, fp): each fingerprint in each of its shards; and how many rows.

    Fingerprints at most two bits apart have a shard in common. Runs a job that looks for
    shards larger than ``TREE_SIZE``, and more where it finds some.
    """
    none = F.lit(-1).cast("bigint").alias("choice"), F.lit(0).cast("bigint").alias("bits")
    rows = distinct.select("fp", *none, F.col("fp").alias("rest"))
    count, settled = distinct.count() * len(PAIRS), []
    for width in BLOCK_BITS:
        rows = _dealt_by_pairs(rows, width)
        if width == BLOCK_BITS[-1]:
            break
        sizes = rows.groupBy(F.col("choice").alias("_choice"), F.col("bits").alias("_bits")).agg(F.count(F.lit(1)).alias("_n"))
        large = cut(sizes.filter(F.col("_n") > TREE_SIZE))
        crowded = large.agg(F.sum("_n")).first()[0]
        if not crowded:
            break
        count += crowded * (len(PAIRS) - 1)
        sized = lookup(rows, large, {"choice": "_choice", "bits": "_bits"})
        settled.append(sized.filter("_n is null").drop("_n"))
        rows = cut(sized.filter("_n is not null").drop("_n"))
    return reduce(DataFrame.unionByName, [*settled, rows]).select("choice", "bits", "fp"), count


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect exactly the
    fingerprints at most ``radius`` (0 to 2) apart; not every pair gets a row."""
    if not 0 <= radius <= BLOCKS - 2:
        raise ValueError(f"two of {BLOCKS} blocks agree only up to a radius of {BLOCKS - 2}")
    rows, count = shards(distinct)
    width = tasks_for(distinct.sparkSession, count, TASK_ROWS)
    return dealt(rows, width, "choice", "bits").mapInArrow(_links(radius), "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for each node of ``links`` (a, b).

    Large-star and small-star steps in turn: each hangs neighbours on the smallest node
    they share, and the number of steps grows with the logarithm of the longest path. Each
    is two aggregations with map-side combine and a join, so a node with very many
    neighbours is never gathered in one place. Lineage is cut after each round.
    """

    def minima(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_v")).select(
            "_u", F.least("_u", "_v").alias("m")
        )

    def state(edges: DataFrame) -> tuple[int, int]:
        row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        return row[0], row[1] or 0

    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = lookup(both, minima(both), {"u": "_u"}, "inner").filter("v > u").select("v", "m").distinct()
        down = large.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = minima(down)
        hung = lookup(down, least, {"u": "_u"}, "inner").select(F.col("v").alias("a"), F.col("m").alias("b"))
        selves = least.select(F.col("_u").alias("a"), F.col("m").alias("b"))
        edges = cut(hung.unionByName(selves).filter("a <> b").distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased (A-Z). A text with fewer words than a shingle is one shingle of
    all its words; a null text or one without words has fingerprint zero, linked like any
    other. ``component_id`` is the smallest id reachable; null ids are smaller than none
    and get the id of their component, or null. Rows with equal ids or texts are rows of
    their own with equal values. Other columns are not read.

    Copies collapse to one fingerprint before anything is compared, and results are joined
    back on the fingerprint, where AQE splits a hot one. Building the plan runs the
    fingerprints and the component steps.
    """
    prints = cut(fingerprints(docs, id=id, text=text, shingle=shingle))
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(near_links(distinct.select("fp"), radius))
    rooted = lookup(distinct, roots, {"fp": "node"}).withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component_id"))
    named = lookup(rooted.select("fp", "root"), least, {"root": "_root"}, "inner").select(
        F.col("fp").alias("_fp"), "component_id"
    )
    return lookup(prints, named, {"fp": "_fp"}, "inner").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """The rows of ``docs`` whose id is that of their component, with all their columns.

    Rows that repeat the id that stays, and rows without an id, stay as well.
    """
    found = near_duplicates(docs, id=id, text=text, shingle=shingle, radius=radius)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs[id] == gone["_gone"], "left_anti")
