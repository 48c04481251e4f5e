"""Revenue reports: per location, last location, crosstab, latest quarter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.columns import RATIO_OPERAND, full_address, quarter_label
from tallywork.operators.ranking import best_with_attributes


def revenue_by_location(
    payments: DataFrame,
    staff: DataFrame,
    stores: DataFrame,
    addresses: DataFrame,
    *,
    staff_key: str,
    store_key: str,
    address_key: str,
    amount: str,
    paid_at: str,
    since: Column,
    address: str = "address",
    address2: str = "address2",
    out: str = "total_amount",
) -> DataFrame:
    """Payments since a date summed per store, with the store's address as one text.

    Payments are summed per staff member before any join: one row per member
    and task leaves the scan stage, however many payments one member has.
    """
    per_staff = payments.filter(F.col(paid_at) >= since).groupBy(staff_key).agg(F.sum(amount).alias("_sum"))
    per_store = (
        per_staff.join(staff.select(staff_key, store_key), staff_key)
        .groupBy(store_key)
        .agg(F.sum("_sum").alias(out))
    )
    return (
        per_store.join(stores.select(store_key, address_key), store_key)
        .join(addresses, address_key)
        .select(store_key, full_address(address, address2).alias("full_address"), out)
        .orderBy(F.col(out).desc_nulls_first(), F.col(store_key))
    )


def top_with_last_location(
    payments: DataFrame,
    rentals: DataFrame,
    copies: DataFrame,
    staff: DataFrame,
    *,
    staff_key: str,
    payment_key: str,
    rental_key: str,
    copy_key: str,
    store_key: str,
    amount: str,
    paid_at: str,
    start: Column,
    end: Column,
    n: int | None = 3,
) -> DataFrame:
    """Staff by revenue in [start, end), with the store of their last payment before ``end``.

    Last means the largest payment id. Revenue and last payment come from one
    pass over the payments; only one rental per member is then looked up.
    """
    paid = F.col(paid_at)
    per_staff = (
        payments.filter(paid < end)
        .groupBy(staff_key)
        .agg(
            F.sum(F.when(paid >= start, F.col(amount))).alias("total_revenue"),
            F.count(F.when(paid >= start, F.lit(1))).alias("_paid"),
            F.max_by(rental_key, payment_key).alias(rental_key),
        )
        .filter("_paid > 0")
        .drop("_paid")
    )
    located = per_staff.join(rentals.select(rental_key, copy_key), rental_key).join(
        copies.select(copy_key, F.col(store_key).alias("last_assigned_store")), copy_key
    )
    order = [F.col("total_revenue").desc_nulls_first(), F.col(staff_key)]
    return best_with_attributes(located.drop(rental_key, copy_key), staff, staff_key, order, n)


def latest_row(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], *, before: tuple[str, Column] | None = None
) -> DataFrame:
    """The newest whole row per key, optionally among rows with a column before a cutoff.

    ``row_number() = 1`` lets Spark keep one row per key in every task before
    the shuffle (WindowGroupLimit), so a hot key costs one row per task.
    """
    if before is not None:
        column, cutoff = before
        df = df.filter(F.col(column) < cutoff)
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def quarter_crosstab(
    sales: DataFrame,
    *,
    row: str,
    quarter: Column,
    amount: str,
    total: str = "year_sum",
) -> DataFrame:
    """One row per ``row`` value, columns q1..q4 (0 where nothing was sold) and their sum.

    The four quarters are fixed, so the pivot needs no extra job to find them.
    """
    names = {1: "q1", 2: "q2", 3: "q3", 4: "q4"}
    wide = (
        sales.withColumn("_q", quarter).groupBy(row).pivot("_q", list(names)).agg(F.sum(amount))
    )
    sold = {name: F.coalesce(F.col(str(q)), F.lit(0)) for q, name in names.items()}
    year_sum = F.round(sold["q1"] + sold["q2"] + sold["q3"] + sold["q4"], 2)
    return wide.select(
        row, *[F.round(c, 2).alias(name) for name, c in sold.items()], year_sum.alias(total)
    ).orderBy(F.col(total).desc(), F.col(row))


def conditional_sums(
    sales: DataFrame,
    *,
    keys: Sequence[str],
    on: str,
    amount: str,
    columns: Mapping[str, object],
    scale: int = 0,
) -> DataFrame:
    """One sum column per value of ``on`` (``columns``: output name -> value), rounded."""
    sums = [
        F.round(F.sum(F.when(F.col(on) == F.lit(v), F.col(amount)).otherwise(F.lit(0))), scale).alias(out)
        for out, v in columns.items()
    ]
    kept = sales.filter(F.col(on).isin(list(columns.values())))
    return kept.groupBy(*keys).agg(*sums).orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def latest_quarter_summary(
    sales: DataFrame,
    pricing: DataFrame,
    stations: DataFrame,
    fuels: DataFrame,
    *,
    pricing_key: str,
    station_key: str,
    fuel_key: str,
    station: str,
    fuel: str,
    quantity: str,
    amount: str,
    sold_at: str,
) -> DataFrame:
    """Per station and fuel: sales of the quarter that holds the newest sale.

    The quarter is a scalar subquery, and sales are summed per price row before
    the lookups.
    """
    newest = sales.agg(F.date_trunc("quarter", F.max(sold_at)).cast("timestamp_ntz").alias("start")).scalar()
    sold = F.col(sold_at)
    per_price = (
        sales.filter((sold >= newest) & (sold < newest + F.expr("INTERVAL 3 MONTHS")))
        .groupBy(pricing_key)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count(amount).alias("_paid"),
            F.sum(quantity).alias("_quantity"),
            F.sum(amount).alias("_amount"),
        )
    )
    average = F.round(
        F.sum("_amount").cast(RATIO_OPERAND) / F.sum("_paid").cast(RATIO_OPERAND), 2
    )
    return (
        per_price.join(pricing.select(pricing_key, station_key, fuel_key), pricing_key)
        .join(stations.select(station_key, station), station_key)
        .join(fuels.select(fuel_key, fuel), fuel_key)
        .groupBy(station, fuel)
        .agg(
            F.sum("_n").alias("total_transactions"),
            F.sum("_quantity").alias("volume_sold"),
            F.sum("_amount").alias("gross_revenue"),
            average.alias("average_transaction_value"),
        )
        .withColumn("period", quarter_label(newest))
        .orderBy(F.col("gross_revenue").desc_nulls_first(), F.col(station), F.col(fuel))
    )
