"""Ordered totals, last values, ranks, frames and numbering without one task per group.

A window with ``ORDER BY`` sends every row of a partition to one task. Here the rows are
cut into range slices of the full sort order (so a single group, a single timestamp or
the whole table spreads over many tasks), each slice is totalled, and a slice's rows start
from the total of the slices before it. There is one plan for every size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.functions.columns import as_column
from tallywork.functions.keys import aside, lookup
from tallywork.session import written


def total_type(value: T.DataType) -> T.DataType:
    """Type of a running total: the widest of its kind, so that it depends on neither the
    number of rows nor the way they were added up."""
    if isinstance(value, T.DecimalType):
        return T.DecimalType(38, value.scale)
    if isinstance(value, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return T.LongType()


def _cut(df: DataFrame, parts: list[str], order: list[Column], slices: int | None) -> DataFrame:
    """``df`` in range slices of its sort order, numbered ``_slice`` and written once."""
    width = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(width, *parts, *order).withColumn("_slice", F.spark_partition_id()))


def running_total(
    df: DataFrame,
    value: Column | str,
    out: str,
    *,
    order_by: Sequence[Column | str],
    partition_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` from the first row of the group to this one.

    ``order_by`` must order the rows of a group totally (end it with a key). ``slices``
    defaults to the session's shuffle partitions; rows of a slice meet in one task.
    The rows are written once to the shared folder: the slice a row fell into is fixed
    that way, while sampling the range bounds again for a second read could cut elsewhere.
    """
    parts = list(partition_by)
    order = [as_column(c) for c in order_by]
    cut = _cut(df.withColumn("_value", as_column(value)), parts, order, slices)
    kind = total_type(cut.schema["_value"].dataType)
    keys = [*parts, "_slice"]
    before = Window.partitionBy(*parts).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # A group has a start in a slice only if an earlier slice holds some of it: that is so
    # for the first group of a slice at most, one row per slice.
    starts = (
        cut.groupBy(*keys)
        .agg(F.sum("_value").cast(kind).alias("_sum"))
        .withColumn("_start", F.sum("_sum").over(before))
        .filter(F.col("_start").isNotNull())
        .drop("_sum")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = F.sum("_value").over(inside)
    joined = lookup(cut, *aside(starts, keys))
    total = F.when(F.col("_start").isNull(), here).otherwise(F.col("_start") + F.coalesce(here, F.lit(0)))
    return joined.withColumn(out, total.cast(kind)).drop("_slice", "_value", "_start")


def running_last(
    df: DataFrame,
    value: Column | str,
    out: str,
    *,
    order_by: Sequence[Column | str],
    partition_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Add ``out``: the last ``value`` that is not null from the first row of the group to this one.

    An ordered carry: every slice finds its own last values, and what a slice ends with is
    carried to the slices after it (the last of two lasts is associative, so the carry needs
    one row per slice and group). ``order_by`` must order the rows of a group totally, up to
    rows with equal values. Rows are written once, as in :func:`running_total`.
    """
    parts = list(partition_by)
    order = [as_column(c) for c in order_by]
    cut = _cut(df.withColumn("_value", as_column(value)), parts, order, slices)
    keys = [*parts, "_slice"]
    inside = Window.partitionBy(*keys).orderBy(*order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = (
        cut.withColumns({"_end": F.last("_value", ignorenulls=True).over(whole), "_first": F.row_number().over(inside)})
        .filter("_first = 1")
        .select(*keys, "_end")
    )
    before = Window.partitionBy(*parts).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ends.withColumn("_start", F.last("_end", ignorenulls=True).over(before))
        .filter(F.col("_start").isNotNull())
        .drop("_end")
    )
    here = F.last("_value", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    joined = lookup(cut.withColumn("_here", here), *aside(starts, keys))
    return joined.withColumn(out, F.coalesce("_here", "_start")).drop("_slice", "_value", "_here", "_start")


def rank_up_to(
    df: DataFrame,
    n: int,
    *,
    order_by: str,
    partition_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Rows whose ``rank()`` by descending ``order_by`` (nulls last) is at most ``n``, for any ``n``.

    The rank is one more than the number of rows with a greater value: a running total of
    the counts per distinct value. So neither a large group nor a value that a third of the
    rows share meets in one task.
    """
    keys = [*partition_by, order_by]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(
        counts, "_n", "_upto", order_by=[F.col(order_by).desc_nulls_last()], partition_by=partition_by, slices=slices
    )
    best = upto.filter(F.col("_upto") - F.col("_n") < n).select(*keys)
    return lookup(df, *aside(best, keys), "left_semi")


# Rows a block of :func:`over_frames` has of its own.
BLOCK_ROWS = 1 << 16


def over_frames(
    df: DataFrame,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    *,
    order_by: Sequence[Column | str],
    lower: int,
    upper: int,
    partition_by: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add window columns whose ROWS frames lie within ``lower`` .. ``upper`` (negative: preceding).

    Rows are numbered in their full order and dealt to blocks of ``block_rows``; each block
    also gets the edge rows of its neighbours that its frames reach (a halo), which are dropped
    again. ``columns`` maps a name to a function of the ordered window. ``order_by`` must order
    the rows of a group totally.
    """
    parts = list(partition_by)
    placed = numbered(df, "_at", order_by=[*[F.col(p) for p in parts], *order_by], start=0, slices=slices)
    size = F.lit(block_rows)

    def block(at: Column) -> Column:
        return F.floor(F.greatest(at, F.lit(0)) / size).cast("bigint")

    home = block(F.col("_at"))
    reached = F.sequence(block(F.col("_at") - F.lit(max(upper, 0))), block(F.col("_at") - F.lit(min(lower, 0))))
    dealt = placed.withColumn("_block", F.explode(reached))
    window = Window.partitionBy(*parts, "_block").orderBy("_at")
    framed = dealt.withColumns({name: make(window) for name, make in columns.items()})
    return framed.filter(F.col("_block") == home).drop("_block", "_at")


def numbered(
    df: DataFrame,
    out: str,
    *,
    order_by: Sequence[Column | str],
    start: int = 1,
    slices: int | None = None,
) -> DataFrame:
    """Consecutive numbers over the whole frame in ``order_by`` order."""
    ranked = running_total(df, F.lit(1).cast("bigint"), out, order_by=order_by, slices=slices)
    return ranked.withColumn(out, (F.col(out) + F.lit(start - 1)).cast("bigint"))


def peer_total(
    df: DataFrame,
    value: str,
    out: str,
    *,
    order_by: str,
    slices: int | None = None,
) -> DataFrame:
    """Running total where rows with an equal ``order_by`` value share one total.

    Equals ``SUM(value) OVER (ORDER BY order_by RANGE UNBOUNDED PRECEDING)``. The sum per
    distinct value comes first, so only distinct values are ordered, and joins back.
    """
    peers = df.groupBy(order_by).agg(F.sum(value).alias("_peer"))
    totals = running_total(
        peers, "_peer", out, order_by=[F.col(order_by).asc_nulls_last()], slices=slices
    ).drop("_peer")
    return lookup(df, *aside(totals, [order_by]), "inner")


_FRAMES = {
    "sum": lambda w: F.sum("_sum").over(w),
    "count": lambda w: F.coalesce(F.sum("_n").over(w), F.lit(0)),
    "avg": lambda w: F.sum("_sum").over(w) / F.sum("_n").over(w),
    "min": lambda w: F.min("_min").over(w),
    "max": lambda w: F.max("_max").over(w),
}


def groups_between(
    df: DataFrame,
    value: str,
    out: str,
    *,
    order_by: str,
    lower: int,
    upper: int,
    partition_by: Sequence[str] = (),
    agg: str = "sum",
) -> DataFrame:
    """``AGG(value) OVER (... GROUPS BETWEEN lower AND upper)``; negative is preceding.

    Spark has no GROUPS frame. Over one row per peer group a ROWS frame is the
    same thing, so peer groups are aggregated first, framed, and joined back:
    the window never sees more rows than there are distinct order values.
    """
    keys = [*partition_by, order_by]
    peers = df.groupBy(*keys).agg(
        F.sum(value).alias("_sum"),
        F.count(value).alias("_n"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    window = (
        Window.partitionBy(*partition_by)
        .orderBy(F.col(order_by).asc_nulls_last())
        .rowsBetween(lower, upper)
    )
    framed = peers.withColumn(out, _FRAMES[agg](window)).select(*keys, out)
    return lookup(df, *aside(framed, keys), "inner")
