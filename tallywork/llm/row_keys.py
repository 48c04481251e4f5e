"""A key of its own for every row, in the order of the ids.

Ids that are all there and all different are their rows' keys. Otherwise rows are sorted by
id and by a hash of all they hold, numbered, and written once, so that every later read and
every retry sees the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.session import written

KEY = "_row_key"
# Stands for a null id; so low that it sorts before all others.
NO_ID = -(1 << 63)
_ROW_BITS = 33


def unique(docs: DataFrame, id: str = "doc_id") -> bool:
    """Whether no id is null or repeated. Only the ids are read and shuffled."""
    ids = docs.select(F.coalesce(F.col(id).cast("bigint"), F.lit(NO_ID)).alias("_k"))
    return ids.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).filter(f"_n > 1 OR _k = {NO_ID}").isEmpty()


def with_row_keys(docs: DataFrame, *, id: str = "doc_id", nulls_last: bool = False) -> DataFrame:
    """``docs`` and the column KEY (bigint): different in every row, not null, and smaller
    where the id is smaller; null ids come first or last.

    Rows with equal ids are numbered by a hash of their columns (maps are left out), so the
    numbers do not depend on the partitions, but for rows equal in all of them. No id can pile
    up: rows are dealt by ranges of id, hash and place. Starts a job when the plan is built,
    and one that writes all rows where ids are null or repeat.
    """
    number = F.col(id).cast("bigint")
    if unique(docs, id):
        # Not nullable by type: joins on it then filter nothing, and equal shuffles are reused.
        return docs.withColumn(KEY, F.coalesce(number, F.lit(NO_ID)))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    null = number.isNull() if nulls_last else number.isNotNull()
    ordered = docs.withColumns(
        {"_null": null, "_id": number, "_hash": F.xxhash64(*hashed), "_place": F.monotonically_increasing_id()}
    )
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["_null", "_id", "_hash", "_place"]
    kept = written(
        ordered.repartitionByRange(width, *by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id())
        .drop(*by)
    )
    part = F.shiftright("_at", _ROW_BITS)
    counts = sorted((r["p"], r["n"]) for r in kept.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0
    for p, n in counts:
        before.append((p, total))
        total += n
    offsets = docs.sparkSession.createDataFrame(before, "_part bigint, _before bigint")
    key = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        kept.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(key, F.lit(NO_ID)).alias(KEY))
    )
