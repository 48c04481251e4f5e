"""Table changes as rewrites: the new table, and separately the rows that changed.

Parquet tables take no UPDATE, DELETE or MERGE, so an operator returns the
DataFrame to be written. Writing over a path that is being read is the sink's
business (:mod:`tallywork.sources.sinks`).

``sift`` is for a target far larger than a batch that is itself too large to broadcast: only
target rows that pass a Bloom filter of the batch's keys are shuffled
(:func:`tallywork.functions.keys.sifted`). The outcome is the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions.keys import absent, among, flagged, lookup, sifted
from tallywork.functions.running import numbered
from tallywork.session import written


class Change(NamedTuple):
    """Outcome of a change: the table afterwards and the rows it touched."""

    table: DataFrame
    rows: DataFrame


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], *, sift: bool = False) -> Change:
    """Append batch rows whose natural key the target does not have."""
    held = sifted(target.select(*keys), batch, keys)[0] if sift else target
    new = absent(batch, held, keys)
    return Change(target.unionByName(new, allowMissingColumns=True), new)


def insert_ignore(
    target: DataFrame, batch: DataFrame, unique: Sequence[str], order_by: Sequence[Column | str]
) -> Change:
    """Append batch rows that conflict neither with the target nor with an earlier batch row.

    ``order_by`` is the order of arrival. Rows with a NULL in ``unique`` never
    conflict. Keeping the first row is a row limit per key, so Spark trims a hot
    key in every task before the shuffle.
    """
    keys = list(unique)
    nothing = F.lit(False)
    for k in keys:
        nothing = nothing | F.col(k).isNull()
    arrival = Window.partitionBy(*keys).orderBy(*order_by)
    first = (
        batch.filter(~nothing)
        .withColumn("_rn", F.row_number().over(arrival))
        .filter("_rn = 1")
        .drop("_rn")
    )
    new = absent(first, target, keys, asked=batch).unionByName(batch.filter(nothing))
    return Change(target.unionByName(new, allowMissingColumns=True), new)


class Lookup(NamedTuple):
    """A dimension to resolve against: ``dim[name] == batch[text]`` gives ``dim[id]`` as ``out``."""

    dim: DataFrame
    name: str
    id: str
    text: str
    out: str


def resolve_keys(batch: DataFrame, lookups: Sequence[Lookup], report: str = "unresolved") -> DataFrame:
    """Natural keys to ids. An unmatched name gives NULL and is listed in ``report``.

    A name with two ids is an error when it is used, as a scalar subquery with
    two rows would be.
    """
    result, missing = batch, []
    for look in lookups:
        ids = (
            look.dim.filter(F.col(look.name).isNotNull())
            .groupBy(F.col(look.name).alias("_name"))
            .agg(F.min(look.id).alias("_id"), F.count(F.lit(1)).alias("_ids"))
        )
        clash = F.raise_error(F.concat(F.lit(f"{look.name} is not unique: "), F.col(look.text).cast("string")))
        result = (
            lookup(result, ids, {look.text: "_name"})
            .withColumn(look.out, F.when(F.col("_ids") > 1, clash).otherwise(F.col("_id")))
            .drop("_id", "_ids")
        )
        gone = F.col(look.out).isNull() & F.col(look.text).isNotNull()
        missing.append(F.when(gone, F.lit(look.out)))
    return result.withColumn(report, F.array_compact(F.array(*missing)))


def assign_ids(
    target: DataFrame,
    batch: DataFrame,
    id_column: str,
    order_by: Sequence[Column | str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Give batch rows ids after the largest id of the target.

    With ``order_by`` (a total order) ids are consecutive. Without it they are unique with
    gaps, as a sequence allows, and need no shuffle; the batch is then written once with
    its ids, because a recomputed task could give its rows other ones.
    """
    last = target.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("last")).scalar()
    if order_by is None:
        placed = written(batch.withColumn(id_column, F.monotonically_increasing_id()))
        return placed.withColumn(id_column, last + F.col(id_column) + F.lit(1))
    ids = numbered(batch, id_column, order_by=order_by, slices=slices)
    return ids.withColumn(id_column, F.col(id_column) + last)


def _replaced(df: DataFrame, hit: Column, values: Mapping[str, object]) -> DataFrame:
    new = {}
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        new[name] = F.when(hit, value.cast(df.schema[name].dataType)).otherwise(F.col(name))
    return df.withColumns(new)


def update_where(
    target: DataFrame,
    values: Mapping[str, object],
    *,
    predicate: Column | None = None,
    keys: DataFrame | None = None,
    on: Sequence[str] = (),
    sift: bool = False,
) -> Change:
    """Set columns where ``predicate`` is true, or where the row's key is in ``keys``, or both."""
    if sift and keys is not None:
        possible, others = sifted(target, keys, on)
        changed = update_where(possible, values, predicate=predicate, keys=keys, on=on)
        return Change(changed.table.unionByName(others), changed.rows)
    hit = F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))
    marked = target if keys is None else flagged(target, keys, on, "_listed")
    marked = marked.withColumn("_hit", hit if keys is None else hit & F.col("_listed"))
    changed = _replaced(marked, F.col("_hit"), values)
    return Change(changed.select(*target.columns), changed.filter("_hit").select(*target.columns))


def update_column(target: DataFrame, column: str, value: object, key: str, key_value: object) -> Change:
    """Set one column of the row with a given key; the value is cast to the column's type."""
    return update_where(target, {column: value}, predicate=F.col(key) == F.lit(key_value))


def delete_where(target: DataFrame, keys: DataFrame, on: Sequence[str], *, sift: bool = False) -> Change:
    """Remove rows by key: the rows kept, and the rows removed."""
    on = list(on)
    if sift:
        possible, others = sifted(target, keys, on)
        changed = delete_where(possible, keys, on)
        return Change(changed.table.unionByName(others), changed.rows)
    return Change(among(target, keys, on, "left_anti"), among(target, keys, on))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs of columns from their defaults."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
            for name, value in defaults.items()
        }
    )


def with_audit_column(df: DataFrame, at: Column | None = None, name: str = "record_ts") -> DataFrame:
    """Add the audit timestamp to every row; a table that has it is left as it is."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def match_pairs(
    entities: DataFrame, items: DataFrame, pairs: DataFrame, *, entity_names: Sequence[str], title: str
) -> DataFrame:
    """Bridge rows from a list of (title, names) pairs.

    The pairs are a DataFrame, so both matches are equi-joins. The same request
    written as OR of conditions would compare every entity with every item.
    """
    return pairs.join(entities, list(entity_names)).join(items, title)
