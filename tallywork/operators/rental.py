"""Reports with checked arguments over rentals, payments and copies.

Arguments are checked before any plan is built. An empty result is a plain
empty frame: looking whether it is empty would force a job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import (
    days_between,
    full_name,
    half_up_int,
    instant,
    month_end,
    quarter_range,
    within,
)
from tallywork.functions.running import numbered
from tallywork.operators.ranking import most_frequent_per_group

FIRST_YEAR = 2000


def _revenue_by_category(
    payments: DataFrame,
    path: Sequence[tuple[DataFrame, str]],
    *,
    category: str,
    amount: str,
    paid_at: str,
    year: int,
    quarter: int,
) -> DataFrame:
    start, end = quarter_range(year, quarter)
    first_key = path[0][1]
    # Summed per first lookup key: the shuffle this needs is the join's own.
    joined = (
        payments.filter(within(paid_at, start, end)).groupBy(first_key).agg(F.sum(amount).alias("_sum"))
    )
    for lookup, key in path:
        joined = joined.join(lookup, key)
    return (
        joined.groupBy(F.col(category).alias("category_name"))
        .agg(F.sum("_sum").alias("total_revenue"))
        .withColumn("result_quarter", F.lit(quarter))
        .withColumn("result_year", F.lit(year))
    )


def current_quarter_revenue(
    payments: DataFrame,
    path: Sequence[tuple[DataFrame, str]],
    *,
    category: str,
    amount: str,
    paid_at: str,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Revenue per category in the quarter of ``as_of`` (default: today).

    ``path`` is the chain of lookups from a payment to its category, each with
    its join key.
    """
    day = as_of or dt.date.today()
    report = _revenue_by_category(
        payments,
        path,
        category=category,
        amount=amount,
        paid_at=paid_at,
        year=day.year,
        quarter=(day.month + 2) // 3,
    )
    return report.withColumnsRenamed({"result_quarter": "current_quarter", "result_year": "current_year"})


def quarter_revenue(
    payments: DataFrame,
    path: Sequence[tuple[DataFrame, str]],
    *,
    category: str,
    amount: str,
    paid_at: str,
    year: int,
    quarter: int,
    this_year: int | None = None,
) -> DataFrame:
    """Revenue per category in a given quarter; impossible quarters raise ``ValueError``."""
    last_year = this_year or dt.date.today().year
    if not 1 <= quarter <= 4:
        raise ValueError(f"quarter must be between 1 and 4, got {quarter}")
    if not FIRST_YEAR <= year <= last_year:
        raise ValueError(f"year must be between {FIRST_YEAR} and {last_year}, got {year}")
    return _revenue_by_category(
        payments, path, category=category, amount=amount, paid_at=paid_at, year=year, quarter=quarter
    )


def most_popular_by_group(
    customers: DataFrame,
    rentals: DataFrame,
    copies: DataFrame,
    items: DataFrame,
    *,
    group: str,
    groups: Sequence[str],
    customer_key: str,
    copy_key: str,
    item_key: str,
    count: str = "rental_count",
) -> DataFrame:
    """Most rented items per group of customers (for example per country); ties kept.

    ``customers`` carries the group name. Unknown groups give no rows. Rentals
    are counted per (customer, copy) first, then per (group, item), and item
    attributes join only the winners.
    """
    members = customers.filter(F.col(group).isin(list(groups))).select(customer_key, group)
    counts = (
        rentals.select(customer_key, copy_key)
        .join(members, customer_key)
        .groupBy(group, copy_key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(copies.select(copy_key, item_key), copy_key)
        .groupBy(group, item_key)
        .agg(F.sum("_n").alias(count))
    )
    return most_frequent_per_group(counts, group=group, count=count).join(items, item_key)


def search_history(
    items: DataFrame,
    copies: DataFrame,
    rentals: DataFrame,
    customers: DataFrame,
    *,
    pattern: str,
    title: str,
    item_key: str,
    copy_key: str,
    customer_key: str,
    rented_at: str,
    tie_break: Sequence[str],
    first_name: str = "first_name",
    last_name: str = "last_name",
    languages: DataFrame | None = None,
    language_key: str = "language_id",
    slices: int | None = None,
) -> DataFrame:
    """Rentals of items whose title matches, newest first, numbered from 1.

    The match is case-insensitive with ``%`` and ``_`` as wildcards. ``tie_break``
    orders rentals of the same moment. With ``languages`` the item's language joins in by
    ``language_key``; items without one are then left out.
    """
    matching = items.filter(F.col(title).ilike(pattern))
    if languages is not None:
        matching = matching.join(languages, language_key)
    found = (
        copies.join(matching, item_key)
        .join(rentals, copy_key)
        .join(customers, customer_key)
        .withColumn("customer_name", full_name(first_name, last_name))
    )
    order = [F.col(rented_at).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    return numbered(found, "row_num", order_by=order, slices=slices)


def rewards(
    payments: DataFrame,
    customers: DataFrame,
    *,
    customer_key: str,
    amount: str,
    paid_at: str,
    min_purchases: int,
    min_amount: object,
) -> DataFrame:
    """Customers over both limits (strictly) in the month of the newest payment."""
    if min_purchases == 0:
        raise ValueError("min_purchases must be greater than 0")
    if min_amount == 0:
        raise ValueError("min_amount must be greater than 0")
    first = payments.agg(F.date_trunc("month", F.max(paid_at)).cast("timestamp_ntz").alias("first")).scalar()
    paid = F.col(paid_at)
    winners = (
        payments.filter((paid >= first) & (paid < first + F.expr("INTERVAL 1 MONTH")))
        .groupBy(customer_key)
        .agg(F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_sum") > F.lit(min_amount)) & (F.col("_n") > min_purchases))
    )
    return customers.join(winners.select(customer_key), customer_key, "left_semi")


def _fees(rentals: DataFrame, *, rented_at: str, returned_at: str, as_of: Column) -> Column:
    rented, back = F.col(rented_at), F.coalesce(F.col(returned_at), as_of)
    day = F.expr("INTERVAL 1 DAY")
    due = rented + F.col("rental_duration") * day
    long_due = rented + F.col("rental_duration") * F.lit(2) * day
    overdue_days = half_up_int(days_between(back, due)).cast("decimal(18,2)")
    late = (
        F.when(back > long_due, F.col("replacement_cost") + overdue_days)
        .when(back > due, overdue_days)
        .otherwise(F.lit(0))
    )
    return F.col("rental_rate") + late


def balance(
    customers: DataFrame,
    rentals: DataFrame,
    copies: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    *,
    customer_key: str,
    copy_key: str,
    item_key: str,
    rented_at: str,
    returned_at: str,
    amount: str,
    paid_at: str,
    as_of: dt.datetime,
    out: str = "balance",
) -> DataFrame:
    """What every customer owes at ``as_of``.

    Rental rate, one unit per day overdue (rounded), the replacement cost when
    kept past twice the rental duration, less payments so far. Open rentals count
    as held until ``as_of``. Fees and payments are one stream of signed amounts,
    summed once per customer; ``items`` has ``rental_rate``, ``rental_duration``
    and ``replacement_cost``.
    """
    moment = instant(as_of)
    charged = (
        rentals.filter(F.col(rented_at) <= moment)
        .join(copies.select(copy_key, item_key), copy_key)
        .join(items.select(item_key, "rental_rate", "rental_duration", "replacement_cost"), item_key)
    )
    fee = _fees(charged, rented_at=rented_at, returned_at=returned_at, as_of=moment)
    entries = charged.select(customer_key, fee.cast("decimal(20,2)").alias("_entry")).unionByName(
        payments.filter(F.col(paid_at) <= moment).select(
            customer_key, (-F.col(amount)).cast("decimal(20,2)").alias("_entry")
        )
    )
    owed = entries.groupBy(customer_key).agg(F.sum("_entry").alias("_owed"))
    return (
        customers.join(owed, customer_key, "left")
        .withColumn(out, F.coalesce(F.col("_owed"), F.lit(0)))
        .drop("_owed")
    )


def copy_status(
    copies: DataFrame,
    rentals: DataFrame,
    *,
    copy_key: Sequence[str],
    returned_at: str,
    order_by: Sequence[str],
    out: str = "is_out",
) -> DataFrame:
    """Every copy with whether its newest rental is still open; never rented is in stock."""
    keys = list(copy_key)
    order = F.struct(*order_by, F.col(returned_at).isNull().alias("_open"))
    newest = rentals.groupBy(*keys).agg(F.max(order)["_open"].alias(out))
    return copies.join(newest, keys, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def available_items(copies: DataFrame, rentals: DataFrame, **columns) -> DataFrame:
    """Copies in stock; see :func:`copy_status`."""
    return copy_status(copies, rentals, **columns).filter(~F.col("is_out")).drop("is_out")


def unavailable_items(copies: DataFrame, rentals: DataFrame, **columns) -> DataFrame:
    """Copies rented out; see :func:`copy_status`."""
    return copy_status(copies, rentals, **columns).filter(F.col("is_out")).drop("is_out")


def stock_counts(copies: DataFrame, keys: Sequence[str], out: str = "copies") -> DataFrame:
    """Number of copies per item and store."""
    return copies.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def held_by(rentals: DataFrame, customers: DataFrame, *, customer_key: str, returned_at: str) -> DataFrame:
    """Open rentals with the customer who holds the copy."""
    return rentals.filter(F.col(returned_at).isNull()).join(customers, customer_key)


def with_month_end(df: DataFrame, day: str, out: str = "month_end") -> DataFrame:
    """Add the last day of the month of ``day``."""
    return df.withColumn(out, month_end(day))
