"""Suffix-array deduplication of bytes by prefix-free parsing.

Rolling-hash triggers cut every document into phrases. The dictionary holds each distinct
phrase once, with its first place in the parse (the phrases in corpus order). Phrases are
as long as a window beyond their last starting point, so a suffix of a phrase says by itself
which windows it begins and the parse needs no suffix array of its own: a phrase that has
occurred before repeats whole. What is left is to compare suffixes of different phrases.
Those that can agree on a window share their trigger, so the dictionary's suffix array is
built trigger by trigger (:func:`tallywork.llm.repeats.suffix_repeats`), and its runs are
put in corpus order through the parse. Suffixes of the phrases of a hot trigger are sorted
by the 128-bit hash of their first 100 bytes instead of the bytes, to spread them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.repeats import Rule, covered, repeated_ranges
from tallywork.llm.row_keys import KEY, with_row_keys
from tallywork.llm.text import slices

# Strings of 100 bytes; triggers are minima over 32 bytes.
RULE = Rule(words=False, k=32, length=100, keep_first=True, suffix_sort=True)
SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def remove_repeated_bytes(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", with_kept: bool = True,
    rule: Rule = RULE,
) -> DataFrame:
    """One row per row of ``docs`` without the bytes covered by a string of ``rule.length``
    bytes that also starts earlier (at a smaller id, or in the same text further left).

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and,
    if asked for, ``kept``: the bytes left, not always whole UTF-8 characters. A null text
    is empty; texts shorter than ``rule.length`` lose nothing. Rows that repeat an id or have
    none (which counts as the smallest id) are places of their own: of equal rows one keeps
    its text. Which of two rows with one id is earlier follows from a hash of id and text.
    Other columns are not read. Equality of phrases is judged by two 64-bit hashes. Building the plan runs the parse.
    """
    texts = with_row_keys(
        docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ).select(F.col(KEY).alias("id"), "text", "doc_id")
    ranges = repeated_ranges(texts, rule)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, value, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = value.encode()
                runs = covered(found, len(raw))
                cuts = [0, *(x for run in runs for x in run), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)) if runs else raw
                rows.append(
                    (key, len(raw), len(raw) - len(left), len(runs),
                     hashlib.sha256(left).hexdigest(), left if with_kept else None)
                )
            columns = [list(c) for c in zip(*rows, strict=True)]
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[p.split()[0] for p in SCHEMA.split(", ")]
            )

    joined = texts.join(ranges, F.col("id") == F.col("_id"), "left").select("doc_id", "text", "ranges")
    out = joined.mapInArrow(kept, SCHEMA)
    return out if with_kept else out.drop("kept")
