"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target number of words. Its documents are dealt into shards, a
shard's words are cut into blocks of (to one word) equal length, and whole blocks are
handed out by highest quotients: first to the sources, then within a source to its
shards. A shard with quota q over n blocks takes all blocks q // n times and q % n
blocks, chosen by a seeded permutation, once more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.keys import lookup
from tallywork.llm.cut import cut
from tallywork.llm.text import WORD, slices


class Mix(NamedTuple):
    """``weights`` repeat over the sources in code point order, null last; the sources
    share ``total`` times all words, none more than ``most`` times its own."""

    weights: Sequence[int] = (5, 2, 1)
    total: float = 1.5
    most: int = 2
    block_words: int = 64
    docs_per_shard: int = 4096
    seed: int = 20261201


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients votes / 1, 3, 5, ...; equal quotients go to the first.

    The quotients themselves need not be listed: a divisor d hands out floor(v / d + 1/2)
    seats, and bisection finds the smallest d that hands out no more than ``seats``; the
    few left over, which lie at ties, go by their next quotient.
    """
    votes = np.asarray(votes, float)
    given = np.zeros(len(votes), np.int64)
    if seats <= 0 or votes.sum() <= 0:
        return given
    low, high = 0.0, 2 * votes.max() + 1
    for _ in range(200):
        middle = (low + high) / 2
        if middle <= low or middle >= high:
            break
        if np.floor(votes / middle + 0.5).sum() <= seats:
            high = middle
        else:
            low = middle
    given = np.floor(votes / high + 0.5).astype(np.int64)
    left = seats - int(given.sum())
    while left > 0:
        top = np.argsort(-votes / (2 * given + 1), kind="stable")[: min(left, int((votes > 0).sum()))]
        given[top] += 1
        left -= len(top)
    return given


def capped_seats(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients, none above its cap; what a cap cuts off goes to the next
    highest quotients of the others, as long as any is below its cap."""
    votes, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    out, open_ = np.zeros(len(votes), np.int64), np.ones(len(votes), bool)
    while True:
        given = sainte_lague(np.where(open_, votes, 0.0), seats - int(out.sum()))
        over = open_ & (given > caps)
        if not over.any():
            return out + given
        out[over] = caps[over]
        open_ &= ~over


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: int) -> np.ndarray:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut off
    is shared again by weight until none is above."""
    out, open_, left = np.zeros(len(sizes)), sizes > 0, float(total)
    while open_.any() and left > 0:
        share = np.where(open_, left * weights / weights[open_].sum(), 0.0)
        over = open_ & (share > most * sizes)
        if not over.any():
            return np.where(open_, share, out)
        out[over] = most * sizes[over]
        left -= out[over].sum()
        open_ &= ~over
    return out


def _source_plan(mix: Mix):
    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        order = sorted(range(len(pdf)), key=lambda i: (pdf["source"][i] is None, (pdf["source"][i] or "").encode()))
        pdf = pdf.iloc[order].reset_index(drop=True)
        sizes = pdf["source_size"].to_numpy(np.float64)
        weights = np.resize(np.array(mix.weights, float), len(pdf))
        pdf["target"] = targets(sizes, weights, mix.total * sizes.sum(), mix.most)
        # Blocks are a little longer or shorter than block_words; votes count them as they are.
        votes = pdf["target"] * pdf["blocks"] / np.maximum(sizes, 1)
        pdf["quota"] = capped_seats(votes.to_numpy(), int(round(votes.sum())), mix.most * pdf["blocks"].to_numpy())
        return pdf[["source", "source_size", "target", "quota"]]

    return plan


def _shard_plan(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("shard").reset_index(drop=True)
    pdf["quota"] = sainte_lague(pdf["blocks"].to_numpy(), int(pdf["quota"].iloc[0])) if len(pdf) else 0
    return pdf[["source", "shard", "blocks", "source_size", "target", "quota"]]


def _chosen(mix: Mix):
    """Per shard: the words taken of each document, and the word ranges of each pass."""

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "size", "print"], na_position="first", kind="stable").reset_index(drop=True)
        sizes = pdf["size"].to_numpy(np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        words, blocks, quota = int(sizes.sum()), int(pdf["blocks"].iloc[0]), int(pdf["quota"].iloc[0])
        passes = [[[] for _ in range(len(pdf))] for _ in range(mix.most)]
        taken = np.zeros(len(pdf), np.int64)
        if words and quota:
            source = pdf["source"].iloc[0]
            name = 0 if source is None else 1 + zlib.crc32(source.encode())
            rng = np.random.default_rng([mix.seed, name, int(pdf["shard"].iloc[0])])
            times = np.full(blocks, quota // blocks, np.int64)
            times[rng.permutation(blocks)[: quota % blocks]] += 1
            bounds = np.arange(blocks + 1, dtype=np.int64) * words // blocks
            before = np.concatenate([[0], np.cumsum(times * np.diff(bounds))])

            def upto(x: np.ndarray) -> np.ndarray:
                at = np.minimum(np.searchsorted(bounds, x, side="right") - 1, blocks - 1)
                return before[at] + times[at] * (x - bounds[at])

            taken = upto(ends) - upto(starts)
            for number, ranges in enumerate(passes, 1):
                edge = np.diff(np.concatenate([[0], (times >= number).astype(np.int8), [0]]))
                opens, closes = bounds[np.flatnonzero(edge == 1)], bounds[np.flatnonzero(edge == -1)]
                first = np.searchsorted(closes, starts, side="right")
                last = np.searchsorted(opens, ends, side="left")
                for i in np.flatnonzero(first < last):
                    cuts = np.stack([opens[first[i] : last[i]], closes[first[i] : last[i]]], axis=1)
                    ranges[i] = (np.clip(cuts, starts[i], ends[i]) - starts[i]).ravel().tolist()
        return pd.DataFrame(
            {
                "doc_id": pdf["id"],
                "size": sizes,
                "source_size": pdf["source_size"],
                "target": pdf["target"],
                "taken": taken,
                "passes": list(map(list, zip(*passes, strict=True))),
            }
        )

    return choose


def in_shards(docs: DataFrame, *, id: str, text: str, source: str, mix: Mix) -> DataFrame:
    """(id, source, size, print, shard): shards of about ``mix.docs_per_shard`` rows of a source, by
    id and text. Written once."""
    narrow = cut(
        docs.select(
            F.col(id).cast("bigint").alias("id"),
            F.col(source).cast("string").alias("source"),
            F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
            F.xxhash64(F.col(text)).alias("print"),
        )
    )
    counts = narrow.groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    shards = F.ceil(F.col("_n") / F.lit(mix.docs_per_shard))
    return lookup(narrow, counts, {"source": "_s"}, "inner").select(
        "id", "source", "size", "print", F.pmod(F.xxhash64("id", "print"), shards).cast("bigint").alias("shard")
    )


def mix_sources(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", mix: Mix = Mix()
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, passes.

    ``size`` counts the words of the text (null: 0). ``passes`` holds for the first,
    second, ... time a document is taken the word ranges [start, end, start, end, ...];
    ``taken`` is their length. No document is taken more than ``mix.most`` times its size,
    because neither a source's nor a shard's quota exceeds that many times its blocks. A source without
    words has target 0. Rows are dealt to shards by id and text, so rows that repeat an id or have
    none spread as well; rows equal in both lie in one shard and may stand for each other. Other
    columns are not read. Runs with the same rows and parameters agree, however the rows are
    partitioned.

    The sizes are cut off once (a narrow checkpoint); of the text nothing is shuffled. One
    row per source meets in one task, one row per shard of a source (a 4096th of its
    documents) in another, and the documents of a shard in a third.
    """
    dealt = in_shards(docs, id=id, text=text, source=source, mix=mix)
    blocks = F.when(F.col("words") == 0, F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.round(F.col("words") / F.lit(mix.block_words)))
    )
    per_shard = (
        dealt.groupBy("source", "shard")
        .agg(F.sum("size").alias("words"))
        .withColumn("blocks", blocks.cast("bigint"))
    )
    per_source = (
        per_shard.groupBy("source")
        .agg(F.sum("words").alias("source_size"), F.sum("blocks").alias("blocks"))
        .withColumn("all", F.lit(1))
        .groupBy("all")
        .applyInPandas(_source_plan(mix), "source string, source_size bigint, target double, quota bigint")
    )
    planned = (
        lookup(per_shard, per_source.withColumnRenamed("source", "_s"), {"source": "_s"}, "inner")
        .groupBy("source")
        .applyInPandas(
            _shard_plan,
            "source string, shard bigint, blocks bigint, source_size bigint, target double, quota bigint",
        )
    )
    joined = lookup(
        dealt, planned.withColumnsRenamed({"source": "_s", "shard": "_h"}), {"source": "_s", "shard": "_h"}, "inner"
    )
    return joined.groupBy("source", "shard").applyInPandas(
        _chosen(mix),
        "doc_id bigint, size bigint, source_size bigint, target double, taken bigint, "
        "passes array<array<bigint>>",
    )


def _cut_text(text: str, ranges: list[int]) -> str:
    """The text from the first to the last word of every range, white space inside kept."""
    raw = np.frombuffer(text.encode(), np.uint8)
    space = np.concatenate([[True], (raw == 32) | ((raw >= 9) & (raw <= 13)), [True]])
    edge = np.diff(space.astype(np.int8))
    opens, closes = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    whole = raw.tobytes()
    if len(ranges) == 2 and ranges[0] == 0 and ranges[1] == len(opens):
        return text
    return b"\n".join(
        whole[opens[a] : closes[b - 1]] for a, b in zip(ranges[::2], ranges[1::2], strict=True) if b > a
    ).decode()


def mixed_documents(
    docs: DataFrame, chosen: DataFrame, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row for each pass that takes
    words of a document, its text cut to them (whole, where all are taken).

    A document that is not taken has no row; one without words has nothing to take. An id
    that repeats is not expected here: its rows would meet each other's ranges.
    """
    fields = docs.schema
    place = docs.columns.index(text)
    picked = chosen.filter("taken > 0").select(F.col("doc_id").alias("_doc"), "passes")
    joined = docs.join(picked, docs[id] == picked["_doc"]).drop("_doc")
    taken = joined.withColumn("_ranges", F.explode(F.filter("passes", lambda p: F.size(p) > 0))).drop("passes")

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [
                _cut_text(value, ranges)
                for value, ranges in zip(
                    batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True
                )
            ]
            columns = [*batch.columns[:-1]]
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*batch.schema][:-1]))

    return taken.select(*docs.columns, "_ranges").mapInArrow(cut_rows, fields)
