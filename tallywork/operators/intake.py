"""Checked intake of batches, derived rows and generated rows.

A batch is judged as a whole: every lookup is a join, and each row leaves with
the first check it failed or with its ids. Nothing is looked up row by row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import instant
from tallywork.functions.keys import aside, lookup
from tallywork.functions.running import numbered
from tallywork.operators.ledger import latest_price, price_as_of, with_product_of

REASON = "reject_reason"


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(REASON).isNotNull())


def _first_id(dim: DataFrame, name: str, key: str, as_name: str, as_id: str) -> DataFrame:
    """One id per name, the lowest where a name repeats."""
    return (
        dim.filter(F.col(name).isNotNull())
        .groupBy(F.col(name).alias(as_name))
        .agg(F.min(key).alias(as_id))
    )


@dataclass(frozen=True)
class SaleTables:
    """Dimensions of a sale.

    customers(customer_id, full_name, email), payment_methods(payment_method_id,
    payment_method_description), employees(employee_id, last_name),
    stations(station_id, station_name), fuel_types(fuel_type_id,
    fuel_description), pricing(pricing_id, station_id, fuel_type_id,
    price_per_unit, effective_date).
    """

    customers: DataFrame
    payment_methods: DataFrame
    employees: DataFrame
    stations: DataFrame
    fuel_types: DataFrame
    pricing: DataFrame


def record_sales(
    batch: DataFrame, tables: SaleTables, *, sold_at: str | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Judge sales given by natural keys and add ids, total and ``reject_reason``.

    Batch columns: customer_full_name, customer_email, station_name, fuel_type,
    employee_last_name, payment_method, quantity_sold. A customer must match by
    name and e-mail, otherwise the sale is a guest sale with a NULL customer.
    The other lookups are mandatory; the first missing one, in the order payment
    method, employee, station, fuel, price, is the reason. With ``sold_at`` the
    price in force on that day is used, else the newest.

    ``keep`` names the batch columns that leave with a sale besides its quantity and day (all, if
    not given). With ``sold_at`` the sales are written once, so what is not kept costs nothing there.
    Customers are looked up last: they are the most, and by then ids stand for the other names.
    """
    people = (
        tables.customers.filter(F.col("email").isNotNull())
        .groupBy(F.col("full_name").alias("_full_name"), F.col("email").alias("_email"))
        .agg(F.min("customer_id").alias("customer_id"))
    )
    methods = _first_id(
        tables.payment_methods, "payment_method_description", "payment_method_id", "_method", "payment_method_id"
    )
    staff = _first_id(tables.employees, "last_name", "employee_id", "_last_name", "employee_id")
    stations = _first_id(tables.stations, "station_name", "station_id", "_station", "station_id")
    fuels = _first_id(tables.fuel_types, "fuel_description", "fuel_type_id", "_fuel", "fuel_type_id")
    found = lookup(batch, methods, {"payment_method": "_method"})
    found = lookup(found, staff, {"employee_last_name": "_last_name"})
    found = lookup(found, stations, {"station_name": "_station"})
    found = lookup(found, fuels, {"fuel_type": "_fuel"})
    found = lookup(found, people, {"customer_full_name": "_full_name", "customer_email": "_email"})
    kept = [F.col(f"`{c}`") for c in batch.columns if keep is None or c in {*keep, "quantity_sold", sold_at}]
    found = found.select(*kept, "customer_id", "payment_method_id", "employee_id", "station_id", "fuel_type_id")
    place = ["station_id", "fuel_type_id"]
    price = {"effective": "effective_date", "columns": ["pricing_id", "price_per_unit"]}
    if sold_at is None:
        newest = latest_price(tables.pricing, keys=place, **price).dropna(subset=place)
        priced = lookup(found, *aside(newest, place))
    else:
        priced = price_as_of(found, tables.pricing, keys=place, sold_at=sold_at, **price)
    totalled = with_product_of(priced, "price_per_unit", "quantity_sold", "total_amount")
    return totalled.withColumn(
        REASON,
        F.when(F.col("payment_method_id").isNull(), "payment method not found")
        .when(F.col("employee_id").isNull(), "employee not found")
        .when(F.col("station_id").isNull(), "station not found")
        .when(F.col("fuel_type_id").isNull(), "fuel type not found")
        .when(F.col("pricing_id").isNull(), "no price set"),
    )


# Attributes of an item added by title alone.
ITEM_DEFAULTS = {"rental_duration": 3, "rental_rate": "4.99", "replacement_cost": "19.99"}
DEFAULT_LANGUAGE = "Klingon"


def _plain(name: Column) -> Column:
    return F.trim(F.upper(name))


def add_items(
    items: DataFrame,
    languages: DataFrame,
    batch: DataFrame,
    *,
    arrival: str,
    this_year: int | None = None,
    title: str = "title",
    language: str = "language_name",
) -> DataFrame:
    """Judge new items; the outcome is that of adding them one after the other.

    ``arrival`` orders the batch (unique). A title, compared without case, that
    the catalogue or an earlier accepted row has is a duplicate; after that the
    language (compared trimmed and without case) must exist. The earliest
    acceptable row per title is an aggregate, not an ordered walk.
    """
    year = dt.date.today().year if this_year is None else this_year
    known = _first_id(
        languages.withColumn("_plain", _plain(F.col("name"))), "_plain", "language_id", "_language", "language_id"
    )
    rows = (
        batch.withColumn("release_year", F.coalesce(F.col("release_year"), F.lit(year)))
        .withColumn(language, F.coalesce(F.col(language), F.lit(DEFAULT_LANGUAGE)))
        .withColumns({"_title": F.upper(title), "_plain": _plain(F.col(language))})
    )
    rows = lookup(rows, known, {"_plain": "_language"})
    taken = items.select(F.upper(title).alias("_title"))
    asked = batch.select(F.upper(title).alias("_title")).distinct()
    existing = taken.join(asked, "_title", "left_semi").select(
        "_title", F.lit(True).alias("_exists"), F.lit(None).cast(rows.schema[arrival].dataType).alias("_first")
    )
    offered = rows.filter(F.col("language_id").isNotNull()).select(
        "_title", F.lit(False).alias("_exists"), F.col(arrival).alias("_first")
    )
    # One row per title and one join with it: two joins in a row on a hot title could not be split.
    titles = (
        existing.unionByName(offered)
        .groupBy(F.col("_title").alias("_known"))
        .agg(F.max("_exists").alias("_exists"), F.min("_first").alias("_first"))
    )
    judged = lookup(rows, titles, {"_title": "_known"})
    duplicate = F.coalesce(F.col("_exists"), F.lit(False)) | F.coalesce(F.col(arrival) > F.col("_first"), F.lit(False))
    return (
        judged.withColumn(
            REASON,
            F.when(duplicate, "duplicate title").when(F.col("language_id").isNull(), "language not found"),
        )
        .withColumns(
            {
                "rental_duration": F.lit(ITEM_DEFAULTS["rental_duration"]),
                "rental_rate": F.lit(ITEM_DEFAULTS["rental_rate"]).cast("decimal(4,2)"),
                "replacement_cost": F.lit(ITEM_DEFAULTS["replacement_cost"]).cast("decimal(5,2)"),
            }
        )
        .drop("_title", "_plain", "_exists", "_first")
    )


def derive_payments(
    rentals: DataFrame,
    copies: DataFrame,
    items: DataFrame,
    *,
    copy_key: str,
    item_key: str,
    title: str,
    amounts: Mapping[str, object],
    otherwise: object = "0.99",
    paid_at: Column | None = None,
) -> DataFrame:
    """One payment per rental, the amount looked up by title."""
    amount = F.lit(otherwise).cast("decimal(10,2)")
    for name, value in amounts.items():
        amount = F.when(F.col(title) == F.lit(name), F.lit(value).cast("decimal(10,2)")).otherwise(amount)
    return (
        rentals.join(copies.select(copy_key, item_key), copy_key)
        .join(items.select(item_key, title), item_key)
        .withColumn("amount", amount)
        .withColumn("payment_date", F.current_timestamp() if paid_at is None else paid_at)
        .drop(item_key, title)
    )


def rental_batch(
    copies: DataFrame,
    items: DataFrame,
    *,
    item_key: str,
    title: str,
    titles: Sequence[str],
    customer_id: object,
    staff_id: object = 1,
    days: int = 7,
    start: dt.datetime | None = None,
) -> DataFrame:
    """Rent every copy of the listed titles to one customer, due in ``days`` days."""
    wanted = items.filter(F.col(title).isin(list(titles))).select(item_key)
    began = F.current_timestamp() if start is None else instant(start)
    return copies.join(wanted, item_key, "left_semi").withColumns(
        {
            "rental_date": began,
            "customer_id": F.lit(customer_id),
            "return_date": began + F.expr(f"INTERVAL {int(days)} DAYS"),
            "staff_id": F.lit(staff_id),
        }
    )


# Multiplier and modulus of the minimal standard generator.
LEHMER_MULTIPLIER = 48271
LEHMER_MODULUS = 2147483647


def _lehmer(state: Column, seed: int, draw: int) -> Column:
    for _ in range(3):
        state = (state * F.lit(LEHMER_MULTIPLIER) + F.lit(seed + draw)) % F.lit(LEHMER_MODULUS)
    return state


def seeded_number(series: Column, seed: int, draw: int = 0) -> Column:
    """Pseudo-random integer of 62 bits from a row's own number.

    Unlike ``rand(seed)`` it does not depend on the partition a row is in, so a retried
    task makes the same rows. Two draws of 31 bits are put together, the second from the
    part of the number above the modulus, so that numbers and keys may exceed 2**31.
    """
    number = series.cast("bigint")
    high = _lehmer(F.pmod(number + F.lit(seed + 7919 * draw + 1), F.lit(LEHMER_MODULUS)), seed, draw)
    above = F.floor(number / F.lit(LEHMER_MODULUS)).cast("bigint")
    low = _lehmer(F.pmod(high + above + F.lit(1), F.lit(LEHMER_MODULUS)), seed + 1, draw)
    return high * F.lit(1 << 31) + low


def seeded_amount(series: Column, seed: int, draw: int, low: str, high: str) -> Column:
    """Amount with two decimals in [low, high], from a row's own number."""
    unit = seeded_number(series, seed, draw) % F.lit(100001)
    width = F.lit(high).cast("decimal(12,2)") - F.lit(low).cast("decimal(12,2)")
    part = width * unit.cast("decimal(6,0)") / F.lit(100000).cast("decimal(6,0)")
    return (F.lit(low).cast("decimal(12,2)") + part).cast("decimal(12,2)")


def seeded_rows(
    series: DataFrame,
    *,
    number: str,
    picks: Sequence[tuple[DataFrame, str]],
    quantity: tuple[str, str] = ("5.00", "55.00"),
    out: str = "quantity_sold",
    start: dt.date,
    step_days: int = 18,
    steps: int = 6,
    seed: int = 1,
    slices: int | None = None,
) -> DataFrame:
    """Synthetic facts: for each number of ``series`` one pick of every key list, an
    amount in a range and a date some steps before ``start``.

    ``picks`` are (frame, key column) pairs. Keys are numbered once and met by an
    equi-join, so each row picks on its own.
    """
    rows = series.select(F.col(number).cast("bigint").alias(number))
    value = F.col(number)
    for draw, (frame, key) in enumerate(picks):
        keys = numbered(frame.select(key).distinct(), "_at", order_by=[key], start=0, slices=slices)
        size = keys.agg(F.count(F.lit(1)).alias("n")).scalar()
        rows = rows.withColumn("_at", seeded_number(value, seed, draw) % size).join(keys, "_at").drop("_at")
    back = (value % F.lit(steps)) * F.lit(step_days)
    return rows.withColumns(
        {
            out: seeded_amount(value, seed, len(picks), *quantity),
            "sale_date": F.date_sub(F.lit(start.isoformat()).cast("date"), back.cast("int")),
        }
    )


def pairs_in_use(facts: DataFrame, pair: Sequence[str]) -> DataFrame:
    """The pairs (station and fuel, say) that occur in ``facts``, once each, with whatever
    columns ``pair`` names.

    The whole grid of two lists has a row for every pair, most of which no fact ever uses;
    it is not built. Repeats combine in every task before the shuffle.
    """
    return facts.select(*pair).distinct()
