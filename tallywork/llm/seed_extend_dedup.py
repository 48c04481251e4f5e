"""Substring deduplication of words by seed and extend.

Seeds are winnowed anchors: the smallest hash of 12 consecutive words in every window of 35.
Documents join on their seeds. A seed match is extended to the left and to the right, as far
as the words agree, up to the edges of the windows that have this seed: first at once, by
the hash of all these words, and where that differs word by word (:mod:`seed_matches`).
Extensions of 35 words and more stay. Any run of 35 words has a seed, so none is missed, and an
extension that reaches an edge meets the one of the next seed there: together they are the
maximal repeats of 35 words and longer, and every word in one goes, in all its places.

The exception is a frequent seed (more than ``repeats.Rule.hot_spans`` different surroundings in one
chunk of a task or ``repeats.SEED_PLACES`` in all): its places would pile up in one task, so its
seeds are made as long as the window, 35 words, and these meet by hash with nothing left to extend.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.repeats import Rule, covered, repeated_ranges
from tallywork.llm.row_keys import KEY, with_row_keys
from tallywork.llm.text import slices

# Runs of 35 words; seeds are minima over 12 words.
RULE = Rule(words=True, k=12, length=35, keep_first=False, suffix_sort=False)
SCHEMA = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
    "repeats array<struct<first:bigint,last:bigint>>, kept string"
)
_REPEATS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def remove_repeated_words(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", with_kept: bool = True,
    rule: Rule = RULE,
) -> DataFrame:
    """One row per row of ``docs`` without the words covered by a run of ``rule.length`` words
    that occurs anywhere else as well.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the words left, joined by one
    space), ``repeats`` (the maximal repeats as first and last word) and, if asked for,
    ``kept``. A null text has no words. Rows that repeat an id or have none are places of
    their own, so equal rows lose what they share, and each row loses only its own
    repeats. Other columns are not read. Equality of whole windows is judged by two 64-bit hashes, of
    words in an extension by one each. Building the plan runs the join on seeds.
    """
    texts = with_row_keys(
        docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ).select(F.col(KEY).alias("id"), "text", "doc_id")
    ranges = repeated_ranges(texts, rule)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, value, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = value.encode().split()
                runs = covered(found, len(words))
                cuts = [0, *(x for run in runs for x in run), len(words)]
                left = list(chain.from_iterable(words[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))) if runs else words
                joined = b" ".join(left)
                rows.append(
                    (key, len(words), len(words) - len(left), hashlib.sha256(joined).hexdigest(),
                     [{"first": a, "last": b - 1} for a, b in runs], joined.decode() if with_kept else None)
                )
            columns = [list(c) for c in zip(*rows, strict=True)]
            types = [pa.int64()] * 3 + [pa.string(), _REPEATS, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "repeats", "kept"],
            )

    joined = texts.join(ranges, F.col("id") == F.col("_id"), "left").select("doc_id", "text", "ranges")
    out = joined.mapInArrow(kept, SCHEMA)
    return out if with_kept else out.drop("kept")
