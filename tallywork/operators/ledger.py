"""Prices, generated amounts and the stock ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import as_column
from tallywork.functions.keys import aside, lookup
from tallywork.functions.running import running_last, running_total
from tallywork.session import written


def price_on_ingest(
    sales: DataFrame,
    pricing: DataFrame,
    *,
    pricing_key: str,
    price: str,
    quantity: str,
    out: str = "total_amount",
) -> DataFrame:
    """Total = price of the sale's price row x quantity; NULL when there is no such price."""
    priced = sales.join(pricing.select(pricing_key, F.col(price).alias("_price")), pricing_key, "left")
    return priced.withColumn(out, (F.col("_price") * F.col(quantity)).cast("decimal(15,2)")).drop("_price")


def with_product_of(df: DataFrame, quantity: str, cost: str, out: str = "total_delivery_value") -> DataFrame:
    """Generated column: quantity x cost as decimal(15,2)."""
    return df.withColumn(out, (F.col(quantity) * F.col(cost)).cast("decimal(15,2)"))


def ledger_from_sources(
    deliveries: DataFrame,
    sales: DataFrame,
    *,
    tank: str,
    delivery_id: str,
    received: str,
    sale_id: str,
    sold: str,
    also: Sequence[str] = (),
) -> DataFrame:
    """One ledger of signed changes: deliveries add, sales take.

    Exactly one of ``sale_id`` / ``delivery_id`` is set on each row.
    """
    keep = [tank, *also]
    arrivals = deliveries.select(
        *keep,
        F.col(received).alias("change_amount"),
        F.lit(None).cast(sales.schema[sale_id].dataType).alias("sale_id"),
        F.col(delivery_id).alias("delivery_id"),
    )
    departures = sales.select(
        *keep,
        (-F.col(sold)).alias("change_amount"),
        F.col(sale_id).alias("sale_id"),
        F.lit(None).cast(deliveries.schema[delivery_id].dataType).alias("delivery_id"),
    )
    return arrivals.unionByName(departures)


def running_stock(
    ledger: DataFrame,
    *,
    tank: Sequence[str],
    change: Column | str,
    order_by: Sequence[Column | str],
    out: str = "remaining_stock",
    slices: int | None = None,
) -> DataFrame:
    """Stock after each change of a tank, starting from 0.

    ``order_by`` ends with the log id. The log is cut into slices of its sort order, so a
    tank with very many changes spreads over tasks (:mod:`tallywork.functions.running`).
    """
    filled = F.coalesce(as_column(change), F.lit(0))
    return running_total(ledger, filled, out, partition_by=tank, order_by=order_by, slices=slices)


def latest_price(
    pricing: DataFrame, *, keys: Sequence[str], effective: str, columns: Sequence[str]
) -> DataFrame:
    """The newest price row per key, as ``columns`` (the row's id first).

    On equal dates the larger id is taken. Max of a struct combines on the map
    side, so a long price history of one key stays one row per task.
    """
    newest = F.max(F.struct(effective, *columns)).alias("_newest")
    return pricing.groupBy(*keys).agg(newest).select(*keys, *[f"_newest.{c}" for c in columns])


def price_as_of(
    sales: DataFrame,
    pricing: DataFrame,
    *,
    keys: Sequence[str],
    sold_at: str,
    effective: str,
    columns: Sequence[str],
) -> DataFrame:
    """Each sale with the price row in force on its day (NULL before the first price).

    An as-of join as one ordered carry: prices and the days that sales ask for, each once per key,
    are put in one order by day, a day's prices (the largest ``columns`` last) before the asked day,
    which takes the last price before it (:func:`tallywork.functions.running.running_last`). A key
    with a third of the sales, or one day of it, is reduced to its days inside the tasks that read
    it. Sales are written once, and so are the answers: every sale looks its answer up, by a
    broadcast where they are few. A sale without a key or a day has no price.
    """
    keys, columns = list(keys), list(columns)
    dated = written(sales).withColumn("_day", F.to_date(sold_at))
    asked = dated.select(*keys, "_day").dropna().distinct().withColumn("_asked", F.lit(True))
    price = pricing.dropna(subset=[*keys, effective]).select(
        *keys, F.to_date(effective).alias("_day"), F.struct(*columns).alias("_price")
    )
    together = price.unionByName(asked, allowMissingColumns=True)
    order = [F.col("_day"), F.col("_price").asc_nulls_last()]
    carried = running_last(together, "_price", "_in_force", order_by=order, partition_by=keys)
    in_force = [F.col(f"_in_force.{c}").alias(c) for c in columns]
    answers = written(carried.filter("_asked").select(*keys, "_day", *in_force))
    return lookup(dated, *aside(answers, [*keys, "_day"])).drop("_day")
