"""Exact deduplication: a two-pass Bloom filter decides which rows have to shuffle.

Pass one counts, for every Bloom position, how many rows set it, and keeps the positions
set at least twice, packed into 64-bit words. Pass two tests every row: only if all its
positions were set twice can its text occur twice. Those rows meet in a shuffle and are
grouped by the SHA-256 of their text; all others pass straight through.

The filter is blocked: all positions of a row lie in one word, so the test is one
map-side join on the word's number and two bit operations. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.keys import lookup
from tallywork.llm.text import ascii_lower

WORDS_PER_ROW = 1 / 4
MAX_WORDS = 1 << 20
BITS = 3


def _signature(text: Column) -> Column:
    """A hash that equal texts share. ``lower`` folds more than A-Z, never less, so it can
    only add candidates, and unlike ``translate`` it is cheap on text that is not ASCII."""
    return F.xxhash64(F.lower(text))


def _position(signature: Column, at: int) -> Column:
    return F.shiftrightunsigned(signature, 6 * at).bitwiseAND(F.lit(63)).cast("int")


def _mask(signature: Column) -> Column:
    return F.expr(" | ".join(f"shiftleft(1L, _p{i})" for i in range(BITS)))


def filter_words(rows: int) -> int:
    """Words of the filter: a power of two near a quarter of the rows (16 bits a row),
    bounded so that the broadcast never exceeds MAX_WORDS rows of 16 bytes (16 MB of data).
    Beyond the bound more rows pass as candidates; the result is the same."""
    size = 1024
    while size < min(rows * WORDS_PER_ROW, MAX_WORDS):
        size *= 2
    return size


def _probes(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with the number of its filter word and its bits in it."""
    positions = {f"_p{i}": _position(F.col("_signature"), i) for i in range(BITS)}
    return (
        docs.withColumns(positions)
        .withColumn("_mask", _mask(F.col("_signature")))
        .withColumn("_word", F.pmod(F.shiftrightunsigned("_signature", 6 * BITS), F.lit(words)))
        .drop("_signature", *positions)
    )


def repeated_positions(signatures: DataFrame, words: int) -> DataFrame:
    """Pass one: (_word, _bits), the positions that two or more rows set.

    Positions are counted with map-side combine, so text that repeats a million times
    leaves a scan task as one row per position, and the text itself is not shuffled.
    """
    positions = F.array(*[_position(F.col("_signature"), i) for i in range(BITS)])
    word = F.pmod(F.shiftrightunsigned("_signature", 6 * BITS), F.lit(words))
    return (
        signatures.select(word.alias("_word"), F.explode(F.array_distinct(positions)).alias("_p"))
        .groupBy("_word", "_p")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .groupBy("_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _p)")).alias("_bits"))
    )


def _tested(docs: DataFrame, id: str, text: str, carried: Column) -> DataFrame:
    """(_id, _sha, _row, _again): pass two. ``carried`` is what stays with each row."""
    rows = docs.select(
        F.col(id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), carried.alias("_row")
    )
    words = filter_words(rows.count())
    signed = rows.withColumn("_signature", _signature(F.col("_text")))
    repeats = repeated_positions(signed.select("_signature"), words)
    hit = F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
    return (
        _probes(signed.withColumn("_sha", F.sha2(ascii_lower(F.col("_text")), 256)).drop("_text"), words)
        .join(F.broadcast(repeats), "_word", "left")
        .select("_id", "_sha", "_row", F.coalesce(hit, F.lit(False)).alias("_again"))
    )


def _met(tested: DataFrame) -> DataFrame:
    """The candidates with keep_id and group_size of their texts: the only rows that shuffle."""
    candidates = tested.filter("_again")
    groups = candidates.groupBy(F.col("_sha").alias("_group")).agg(
        F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return lookup(candidates, groups, {"_sha": "_group"}, "inner")


def exact_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the row that stays of its group of equal texts.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Returns
    doc_id, keep_id (the largest id of the group), group_size, kept and text_sha256 (of the
    lower-cased text), and may_repeat, the Bloom filter's answer. Rows that repeat an id
    with its text are one document: all of them carry the same values. A null id never
    stays beside another id; a group of null ids only has a null keep_id and stays.
    Other columns are not read. Counting the rows starts a job when the plan is built.
    """
    tested = _tested(docs, id, text, F.lit(None).cast("int"))
    alone = tested.filter("NOT _again").withColumns({"keep_id": F.col("_id"), "group_size": F.lit(1).cast("bigint")})
    return (
        _met(tested)
        .unionByName(alone)
        .select(
            F.col("_id").alias("doc_id"),
            "keep_id",
            "group_size",
            F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("_sha").alias("text_sha256"),
            F.col("_again").alias("may_repeat"),
        )
    )


def without_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns."""
    tested = _tested(docs, id, text, F.struct(*[docs[f"`{c}`"] for c in docs.columns]))
    stays = _met(tested).filter(F.col("_id").eqNullSafe(F.col("keep_id")))
    return stays.select("_row.*").unionByName(tested.filter("NOT _again").select("_row.*"))


SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
