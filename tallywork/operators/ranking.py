"""Top-n reports. Ties are kept: ``rank``, never ``row_number``.

Spark trims ``rank() <= n`` in every task before the shuffle (WindowGroupLimit) for ``n`` up to
``spark.sql.optimizer.windowGroupLimitThreshold``, so what reaches a group's task is n rows and
their ties from each task, not the group. A larger ``n`` is ranked in slices
(:func:`tallywork.functions.running.rank_up_to`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import share_of
from tallywork.functions.running import rank_up_to

# Up to here Spark trims ranked rows in every task before the shuffle (the default of
# spark.sql.optimizer.windowGroupLimitThreshold).
LARGEST_N = 1000


def _best(df: DataFrame, n: int, groups: Sequence[str], measure: str, slices: int | None) -> DataFrame:
    """Rows of rank up to ``n`` by descending ``measure`` in their group, ties kept."""
    if n < 1:
        raise ValueError(f"n must be at least 1, not {n}")
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", str(LARGEST_N)))
    if n > limit:
        return rank_up_to(df, n, order_by=measure, partition_by=groups, slices=slices)
    order = Window.partitionBy(*groups).orderBy(F.col(measure).desc_nulls_last())
    return df.withColumn("_rank", F.rank().over(order)).filter(F.col("_rank") <= n).drop("_rank")


def best_with_attributes(
    measured: DataFrame, entities: DataFrame, key: str, order_by: Sequence[Column], n: int | None
) -> DataFrame:
    """``measured`` with the attributes of its entities (unique by ``key``), ordered; with
    ``n`` the first n only.

    Which rows are the first n is settled on measures and keys; only they get attributes.
    Rows without an entity are dropped before they are counted.
    """
    if n is None:
        return measured.join(entities, key).orderBy(*order_by)
    best = measured.join(entities.select(key), key, "left_semi").orderBy(*order_by).limit(n)
    return best.join(entities, key).orderBy(*order_by)


def top_n_per_group_with_share(
    sales: DataFrame,
    *,
    group: str,
    member: str,
    amount: str,
    n: int = 5,
    total: str = "total_sales",
    share: str = "sales_percentage",
    slices: int | None = None,
) -> DataFrame:
    """The ``n`` best members per group, ties kept, with their share of the whole group.

    The group total is a second aggregate over the same per-member sums (Spark
    reuses their shuffle) and joins only the few ranked rows. A window total
    would send all members of a group to one task.
    """
    sums = sales.groupBy(group, member).agg(F.sum(amount).alias(total))
    best = _best(sums, n, [group], total, slices)
    totals = sums.groupBy(group).agg(F.sum(total).alias("_whole"))
    return (
        best.join(totals, group)
        .withColumn(share, F.round(share_of(total, "_whole"), 4))
        .drop("_whole")
        .orderBy(F.col(group), F.col(total).desc(), F.col(member))
    )


def consistent_top_n(
    sales: DataFrame,
    *,
    period: str,
    group: str,
    member: str,
    amount: str,
    periods: Sequence[object],
    n: int = 300,
    out: str = "amount_sold",
    slices: int | None = None,
) -> DataFrame:
    """Members ranked in the top ``n`` of their group in every one of ``periods``, with the sum."""
    sums = (
        sales.filter(F.col(period).isin(list(periods)))
        .groupBy(period, group, member)
        .agg(F.sum(amount).alias("_sum"))
    )
    best = _best(sums, n, [period, group], "_sum", slices)
    # One row per period here, so counting rows counts periods.
    return (
        best.groupBy(group, member)
        .agg(F.sum("_sum").alias(out), F.count(F.lit(1)).alias("_periods"))
        .filter(F.col("_periods") == len(set(periods)))
        .drop("_periods")
        .orderBy(F.col(out).desc(), F.col(group), F.col(member))
    )


def most_frequent_per_group(
    counts: DataFrame, *, group: str, count: str
) -> DataFrame:
    """Rows of ``counts`` that hold the largest count of their group; ties kept."""
    order = Window.partitionBy(group).orderBy(F.col(count).desc_nulls_last())
    return counts.withColumn("_rank", F.rank().over(order)).filter("_rank = 1").drop("_rank")
