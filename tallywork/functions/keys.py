"""Joins to key sets and dimensions, shaped so that a hot key can be split.

AQE splits a skewed join partition only where both inputs are plain shuffles. A
side that was just aggregated (``distinct``, ``groupBy``) is joined in the
aggregate's own layout, without a shuffle in between, and then nothing is split.
The joins here compare null-safely: Spark does not take the aggregate's layout
for that comparison and exchanges the side again, which is cheap, as it is already
reduced. NULL keys are removed from that side, so no match changes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key columns without repeats and NULLs; a key held by a third of the
    rows is reduced to one row per task before the shuffle."""
    return df.select(*keys).dropna().distinct()


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join ``df`` to a frame with unique keys; a NULL key would match a NULL.

    ``on`` maps df column -> dim column; the dim's key columns are dropped.
    """
    matched = [F.col(left).eqNullSafe(F.col(right)) for left, right in on.items()]
    return df.join(dim, matched, how).drop(*on.values())


def aside(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its keys renamed so that they cannot be confused, and the mapping
    :func:`lookup` takes."""
    renamed = {k: f"_k_{k}" for k in keys}
    return df.withColumnsRenamed(renamed), renamed


def among(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_anti``: is not) one of ``keys``, repeats allowed."""
    return lookup(df, *aside(distinct_keys(keys, on), on), how)


def absent(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], asked: DataFrame | None = None
) -> DataFrame:
    """Rows of ``batch`` with no equal key in ``target`` (a NULL key is never equal).

    ``target`` is the large side, so it is first cut down to the keys the batch
    asks about: with a small batch that is a map-side filter and no row of
    ``target`` outside the batch is shuffled. ``asked`` may name a cheaper frame
    that holds the batch's keys, such as the batch before a transformation.
    """
    keys = list(keys)
    found = among(target.select(*keys), batch if asked is None else asked, keys)
    return among(batch, found, keys, "left_anti")


def flagged(df: DataFrame, keys: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Add a boolean ``flag``: the row's key occurs in ``keys``. One scan of ``df``."""
    marked, renamed = aside(distinct_keys(keys, on).withColumn(flag, F.lit(True)), on)
    return lookup(df, marked, renamed).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


# A filter's size: 64-bit words, sixteen bits a key, at most 16 MB of (word, bits) pairs.
KEYS_PER_WORD = 4
MAX_WORDS = 1 << 20
BITS_PER_KEY = 3


def _word_and_mask(keys: Sequence[Column], words: int) -> tuple[Column, Column]:
    """Which word of the filter a key belongs to, and its bits in it."""
    mixed = F.xxhash64(*keys)
    bits = [F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_PER_KEY)]
    mask = F.lit(0).cast("bigint")
    for bit in bits:
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return F.pmod(F.shiftrightunsigned(mixed, 6 * BITS_PER_KEY), F.lit(words)), mask


def sifted(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose key may be one of ``keys``, and rows whose key is not.

    For a ``df`` far larger than ``keys`` when ``keys`` are too many to broadcast: a blocked Bloom
    filter of them, sized from their number and never above MAX_WORDS words, is broadcast
    instead, so that only rows of the first frame need a shuffle. A filter that is full lets more
    rows into the first frame, never a matching one into the second. Counting the keys starts a
    job when the plan is built; both frames scan ``df``.
    """
    typed = distinct_keys(keys, on).select(*[F.col(k).cast(df.schema[k].dataType).alias(k) for k in on])
    words = 1 << 10
    count = typed.count()
    while words < min(count / KEYS_PER_WORD, MAX_WORDS):
        words *= 2
    word, mask = _word_and_mask([F.col(k) for k in on], words)
    bits = typed.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    tested = df.withColumns({"_word": word, "_mask": mask}).join(F.broadcast(bits), "_word", "left")
    may = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return tested.filter(may).select(*columns), tested.filter(~may).select(*columns)
