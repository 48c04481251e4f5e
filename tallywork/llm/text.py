"""Text rules shared by the corpus operators.

A word is a run of characters other than the ASCII white space bytes 0x09-0x0D and
0x20. ``bytes.split()`` cuts at exactly these bytes.
"""

from __future__ import annotations

import os
import string
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tallywork

WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACES = b" \t\n\x0b\x0c\r"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Workers start in a folder of their own. On one machine the driver's path serves them;
    on a cluster the package is installed, or sent with ``--py-files``, as any other.
    """
    home = str(Path(tallywork.__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII text takes the fast built-in."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def slices(batches: Iterator[pa.RecordBatch], max_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what Python makes of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, max_rows):
            yield batch.slice(at, max_rows)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and the n + 1 offsets; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def small_pieces(
    batches: Iterator[pa.RecordBatch], text: int, max_bytes: int = 1 << 20, max_rows: int = 2048
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the text column of each holds about ``max_bytes`` at most;
    a longer single text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(
            pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ).astype(np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            upto = int(np.searchsorted(ends, base + max_bytes, side="right"))
            upto = min(max(upto, at + 1), at + max_rows, batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto


def tasks_for(spark: SparkSession, amount: int, each: int) -> int:
    """Tasks for ``amount`` rows or bytes with about ``each`` to a task: the session's number of
    shuffle partitions, or more where that would give a task too much."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-amount // each))


def dealt(df: DataFrame, tasks: int, *by: str) -> DataFrame:
    """``df`` shuffled by columns over at least ``tasks`` tasks; where the session has as many
    already, small ones may be merged at run time."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(*by) if tasks <= usual else df.repartition(tasks, *by)


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; a job that reads them."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).alias("n")).first()["n"]
