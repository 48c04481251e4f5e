"""Keys that occur in two fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.keys import among


def active_in_both(
    left: DataFrame,
    right: DataFrame,
    *,
    key: str,
    more_than: int | tuple[int, int] = 43,
    n: int | None = 1,
) -> DataFrame:
    """Keys with more than a number of rows in each table, largest key first.

    ``n=1`` gives the single largest key, ``n=None`` all of them.
    """
    low_left, low_right = more_than if isinstance(more_than, tuple) else (more_than, more_than)
    in_left = left.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows")).filter(F.col("left_rows") > low_left)
    in_right = right.groupBy(key).agg(F.count(F.lit(1)).alias("right_rows")).filter(
        F.col("right_rows") > low_right
    )
    both = in_left.join(in_right, key).orderBy(F.col(key).desc())
    return both if n is None else both.limit(n)


def exists_in_both(entities: DataFrame, left: DataFrame, right: DataFrame, *, key: str) -> DataFrame:
    """Entities with at least one row in each table.

    The facts are reduced to distinct keys first; a semi join alone would
    shuffle every fact row of a key.
    """
    return among(among(entities, left, [key]), right, [key])
