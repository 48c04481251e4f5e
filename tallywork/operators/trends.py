"""Reports over time: gaps, shares, running and centered averages, frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallywork.functions.columns import amount_text, as_column, percent_text, share_of
from tallywork.functions.running import groups_between, over_frames, peer_total


def next_gap(
    events: DataFrame,
    *,
    entity: str,
    item: str,
    year: str,
    next_year: str = "next_release_year",
    gap: str = "gap_size",
    years: DataFrame | None = None,
) -> DataFrame:
    """For each distinct (entity, item, year): the entity's next later year and the gap.

    Items in an entity's last year are dropped. ``lead`` runs over the distinct years of an
    entity (equal years cannot be "next"), which are few, and joins back, so no task holds
    all items of an entity and nothing is paired up. ``years`` may give the rows (entity,
    year) from a cheaper frame than ``events``, whose joins would otherwise run twice; it
    must have no year of an entity that ``events`` lacks.
    """
    known = (events if years is None else years).select(F.col(entity).alias("_entity"), F.col(year).alias("_year"))
    ordered = Window.partitionBy("_entity").orderBy("_year")
    following = (
        known.distinct()
        .withColumn(next_year, F.lead("_year").over(ordered))
        .filter(F.col(next_year).isNotNull())
    )
    return (
        events.select(entity, item, year)
        .distinct()
        .join(following, (F.col(entity) == F.col("_entity")) & (F.col(year) == F.col("_year")))
        .drop("_entity", "_year")
        .withColumn(gap, F.col(next_year) - F.col(year))
        .orderBy(F.col(gap).desc(), F.col(item).desc_nulls_first())
    )


def share_and_prior(
    sales: DataFrame,
    *,
    year: str,
    region: str,
    channel: str,
    amount: str,
    first_year: int,
    out: str = "amount_sold",
) -> DataFrame:
    """Channel share of the (year, region) total, the prior year's share, and the change.

    Rows of the year before ``first_year`` only feed the prior share and are
    filtered after the window. Both shares are rounded before they are subtracted.
    """
    sums = sales.groupBy(region, year, channel).agg(F.sum(amount).alias(out))
    whole = Window.partitionBy(year, region)
    over_time = Window.partitionBy(region, channel).orderBy(F.col(year).asc_nulls_last())
    return (
        sums.withColumn("_share", share_of(F.col(out), F.sum(out).over(whole)))
        .withColumn("by_channels", F.round("_share", 2))
        .withColumn("previous_period", F.round(F.lag("_share").over(over_time), 2))
        .withColumn("delta", F.col("by_channels") - F.col("previous_period"))
        .filter(F.col(year) >= first_year)
        .drop("_share")
        .orderBy(region, year, channel)
    )


def share_report_text(report: DataFrame, amount: str = "amount_sold") -> DataFrame:
    """The share report with its amounts and percentages as display text."""
    return (
        report.withColumn(amount, amount_text(amount))
        .withColumn("by_channels", percent_text("by_channels"))
        .withColumn("previous_period", percent_text("previous_period"))
        .withColumn("delta", percent_text("delta"))
    )


def daily_totals(sales: DataFrame, *, day: str, amount: str, out: str = "sales") -> DataFrame:
    """One row per day that has sales, whatever the time of day. The windows below run on
    these few rows."""
    return sales.groupBy(F.to_date(day).alias(day)).agg(F.sum(amount).alias(out))


def iso_year(day: Column | str) -> Column:
    """The year an ISO week belongs to: week 1 of 1997 begins in December 1996."""
    return F.extract(F.lit("YEAROFWEEK"), as_column(day))


def cumulative_in_period(
    daily: DataFrame, *, period: Sequence[str], day: str, amount: str, out: str = "cum_sum"
) -> DataFrame:
    """Running total by day inside a period such as a week."""
    window = (
        Window.partitionBy(*period).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn(out, F.sum(amount).over(window))


# Rows before and after the current one: every day, and the two days beside the weekend.
CENTERED = (-1, 1)
CENTERED_BY_WEEKDAY = {"Monday": (-2, 1), "Friday": (-1, 2)}


def centered_average(
    daily: DataFrame,
    *,
    day: str,
    weekday: Column,
    amount: str,
    out: str = "centered_avg",
    default: tuple[int, int] = CENTERED,
    by_weekday: Mapping[str, tuple[int, int]] = CENTERED_BY_WEEKDAY,
    keep: Column | None = None,
    **blocks: int,
) -> DataFrame:
    """Average of neighbouring rows, with a wider frame on given weekdays.

    ``daily`` has one row per ``day``, however many there are: rows are framed in blocks
    (``blocks``: see :func:`tallywork.functions.running.over_frames`). Rows count
    days that exist: a missing day widens the span. ``keep`` filters after the
    window, so earlier and later days can warm the frame up.
    """

    def average(ordered: WindowSpec) -> Column:
        def over(frame: tuple[int, int]) -> Column:
            return F.round(F.avg(amount).over(ordered.rowsBetween(*frame)), 2)

        chosen = over(default)
        for name, frame in by_weekday.items():
            chosen = F.when(weekday == F.lit(name), over(frame)).otherwise(chosen)
        return chosen

    frames = [default, *by_weekday.values()]
    result = over_frames(
        daily, {out: average}, order_by=[day], lower=min(f[0] for f in frames), upper=max(f[1] for f in frames), **blocks
    )
    return result if keep is None else result.filter(keep)


def rolling_rows_average(
    daily: DataFrame,
    *,
    day: str,
    amount: str,
    rows: int = 3,
    out: str = "rolling_3day_avg",
    keep: Column | None = None,
    **blocks: int,
) -> DataFrame:
    """Average of the current and the ``rows - 1`` rows before it, over one row per day, framed
    in blocks as in :func:`centered_average`."""

    def average(ordered: WindowSpec) -> Column:
        return F.avg(amount).over(ordered.rowsBetween(1 - rows, Window.currentRow))

    result = over_frames(daily, {out: average}, order_by=[day], lower=1 - rows, upper=0, **blocks)
    return result if keep is None else result.filter(keep)


def range_running_total(
    sales: DataFrame,
    *,
    price: str,
    quantity: str,
    out: str = "cumulative_qty_by_price",
    slices: int | None = None,
) -> DataFrame:
    """Running quantity by price over raw rows; rows with one price share one total.

    Rows are not sorted: order the result by ``price`` to print it.
    """
    return peer_total(sales, quantity, out, order_by=price, slices=slices)


def groups_frame_total(
    daily: DataFrame,
    *,
    period: str,
    amount: str,
    partition_by: Sequence[str] = (),
    out: str = "two_week_promo_total",
) -> DataFrame:
    """Each row's total of its own and the previous period, however many rows they have."""
    return groups_between(
        daily, amount, out, order_by=period, lower=-1, upper=0, partition_by=partition_by
    )
