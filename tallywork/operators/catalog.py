"""Catalogue reports over items, a many-to-many bridge and small lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.running import running_total
from tallywork.operators.ranking import best_with_attributes


def filtered_catalog(
    items: DataFrame,
    bridge: DataFrame,
    categories: DataFrame,
    *,
    item_key: str,
    category_key: str,
    name: str,
    category: object,
    year: str,
    years: tuple[object, object],
    rate: str,
    min_rate: object,
) -> DataFrame:
    """Items of one category with ``year`` in a closed range and ``rate`` above a limit.

    One row per bridge row. Both filters stand below the joins, next to the scans.
    """
    wanted = categories.filter(F.col(name) == F.lit(category))
    kept = items.filter(F.col(year).between(*years) & (F.col(rate) > F.lit(min_rate)))
    return bridge.join(wanted, category_key).join(kept, item_key)


def top_by_count(
    entities: DataFrame,
    bridge: DataFrame,
    items: DataFrame,
    *,
    entity_key: str,
    item_key: str,
    after: tuple[str, object],
    out: str,
    n: int | None = 5,
) -> DataFrame:
    """Entities with the most bridge rows to items whose ``after`` column exceeds a value.

    Items only filter the bridge (semi join); the count per entity, and the choice of the
    first n, come before the entity attributes are joined. Equal counts are ordered by key.
    """
    column, value = after
    recent = items.filter(F.col(column) > F.lit(value)).select(item_key)
    counts = bridge.join(recent, item_key, "left_semi").groupBy(entity_key).agg(
        F.count(F.lit(1)).alias(out)
    )
    return best_with_attributes(counts, entities, entity_key, [F.col(out).desc(), F.col(entity_key)], n)


def conditional_counts(
    items: DataFrame,
    bridge: DataFrame,
    categories: DataFrame,
    *,
    item_key: str,
    category_key: str,
    name: str,
    year: str,
    columns: Mapping[str, object],
) -> DataFrame:
    """One count column per category (``columns``: output name -> category), per year, newest first.

    Bridge rows are counted per (item, category) before items are joined, so an
    item or category holding most of the bridge is reduced on the map side.
    """
    wanted = categories.filter(F.col(name).isin(list(columns.values())))
    pairs = bridge.join(wanted, category_key).groupBy(item_key, name).agg(F.count(F.lit(1)).alias("_n"))
    joined = pairs.join(items.select(item_key, year), item_key)
    counts = [
        F.coalesce(F.sum(F.when(F.col(name) == F.lit(category), F.col("_n"))), F.lit(0)).alias(out)
        for out, category in columns.items()
    ]
    return joined.groupBy(year).agg(*counts).orderBy(F.col(year).desc_nulls_first())


def popular_with_band(
    items: DataFrame,
    copies: DataFrame,
    rentals: DataFrame,
    *,
    item_key: str,
    copy_key: str,
    rating: str,
    bands: Mapping[object, str],
    otherwise: str = "Unrated",
    count: str = "rental_count",
    band: str = "target_audience_age",
    n: int | None = 5,
) -> DataFrame:
    """Most rented items with a label looked up from their rating."""
    per_copy = rentals.groupBy(copy_key).agg(F.count(F.lit(1)).alias("_n"))
    per_item = (
        per_copy.join(copies.select(copy_key, item_key), copy_key)
        .groupBy(item_key)
        .agg(F.sum("_n").alias(count))
    )
    label = F.lit(otherwise)
    for value, text in bands.items():
        label = F.when(F.col(rating) == F.lit(value), F.lit(text)).otherwise(label)
    order = [F.col(count).desc(), F.col(item_key)]
    return best_with_attributes(per_item, items.withColumn(band, label), item_key, order, n)


def inactivity(
    entities: DataFrame,
    bridge: DataFrame,
    items: DataFrame,
    *,
    entity_key: str,
    item_key: str,
    year: str,
    as_of_year: int | None = None,
    latest: str = "latest_release",
    out: str = "years_of_inactivity",
) -> DataFrame:
    """Years between an entity's latest item and ``as_of_year`` (default: this year)."""
    now = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    newest = (
        bridge.join(items.select(item_key, year), item_key)
        .groupBy(entity_key)
        .agg(F.max(year).alias(latest))
    )
    return (
        newest.join(entities, entity_key)
        .withColumn(out, now - F.col(latest))
        .orderBy(F.col(out).desc_nulls_first(), F.col(entity_key))
    )


def joined_text(
    df: DataFrame, keys: Sequence[str], text: str, out: str, separator: str = ", "
) -> DataFrame:
    """Texts of a group in one string, in text order; NULL texts are skipped and
    a group with none gives NULL. The result is one cell per group, so a group's
    text must fit in one value; ``keys`` should be as fine as the list is meant, or see
    :func:`joined_text_parts`."""
    listed = df.groupBy(*keys).agg(F.sort_array(F.collect_list(text)).alias(out))
    joined = F.array_join(out, separator)
    return listed.withColumn(out, F.when(F.size(out) > 0, joined))


def joined_text_parts(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    out: str,
    separator: str = ", ",
    *,
    part: str = "part",
    part_rows: int = 10_000,
    slices: int | None = None,
) -> DataFrame:
    """:func:`joined_text` in parts of ``part_rows`` texts, numbered from 0 in text order.

    Parts put together with the separator are the whole text. Texts are numbered in slices
    of their order, so a key with any share of the rows is many parts from many tasks.
    Groups without a text have no part.
    """
    named = df.select(*keys, text).filter(F.col(text).isNotNull())
    placed = running_total(named, F.lit(1).cast("bigint"), "_at", order_by=[text], partition_by=keys, slices=slices)
    number = F.floor((F.col("_at") - 1) / F.lit(part_rows)).cast("bigint")
    return joined_text(placed.withColumn(part, number), [*keys, part], text, out, separator)
