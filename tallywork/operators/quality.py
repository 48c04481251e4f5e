"""Data-quality rules: each returns the rows that break it.

A check passes on NULL, as a CHECK constraint does: a row breaks a rule only
where the condition is false, not where it is unknown.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallywork.functions.columns import instant
from tallywork.functions.keys import flagged
from tallywork.sources.sinks import write_batch
from tallywork.sources.tables import inline_rows


def is_false(condition: Column) -> Column:
    """True where the condition is false; unknown is not false."""
    return F.coalesce(~condition, F.lit(False))


def violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is false. A filter drops what is unknown by itself, and in
    this form simple conditions reach the scan."""
    return df.filter(~condition)


def labelled_violations(df: DataFrame, rules: Mapping[str, Column], out: str = "rule") -> DataFrame:
    """Violations of several rules in one scan, a row for each rule a row breaks."""
    broken = F.array_compact(F.array(*[F.when(is_false(c), F.lit(name)) for name, c in rules.items()]))
    return df.withColumn(out, F.explode(broken))


# Conditions of the row rules.


def date_window(c: str, earliest: dt.date | dt.datetime, latest: dt.date | dt.datetime | None = None) -> Column:
    """earliest <= c <= latest (default: now)."""
    upper = F.current_timestamp() if latest is None else instant(latest)
    return (F.col(c) >= instant(earliest)) & (F.col(c) <= upper)


def after(c: str, day: dt.date) -> Column:
    return F.col(c) > instant(day)


def exactly_one(left: str, right: str) -> Column:
    """Exactly one of two references is set."""
    return F.col(left).isNull() != F.col(right).isNull()


def above(c: str, limit: object = 0) -> Column:
    return F.col(c) > F.lit(limit)


def at_least(c: str, limit: object = 0) -> Column:
    return F.col(c) >= F.lit(limit)


def required(c: str) -> Column:
    return F.col(c).isNotNull()


def max_length(c: str, n: int) -> Column:
    return F.length(c) <= n


def in_domain(c: str, values: Sequence[object]) -> Column:
    return F.col(c).isin(list(values))


def differs(left: str, right: str) -> Column:
    return F.col(left) != F.col(right)


# Rules over keys.


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "copies") -> DataFrame:
    """Keys held by more than one row. A key with a NULL part never collides."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)
    )


def missing_parents(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key no parent has."""
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return child.filter(F.col(key).isNotNull()).join(
        parents, F.col(key) == F.col("_parent"), "left_anti"
    )


# Rules by name, for running many at once.


@dataclass(frozen=True)
class Check:
    """A condition every row of ``table`` must not break."""

    name: str
    table: str
    condition: Column


@dataclass(frozen=True)
class Unique:
    name: str
    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    name: str
    table: str
    key: str
    parent: str
    parent_key: str


Rule = Check | Unique | ForeignKey


def broken_rows(rule: Rule, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The violations of one rule."""
    df = tables[rule.table]
    if isinstance(rule, Check):
        return violations(df, rule.condition)
    if isinstance(rule, Unique):
        return duplicate_keys(df, rule.keys)
    return missing_parents(df, rule.key, tables[rule.parent], rule.parent_key)


def _counts(rules: Sequence[Check]) -> list[Column]:
    return [F.count(F.when(is_false(r.condition), F.lit(1))).alias(r.name) for r in rules]


def _one_pass(df: DataFrame, table: str, rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """The counts of the rules of a table, at most one of them Unique, from one scan of it.

    Foreign keys are marked by a join with the distinct parent keys. With a Unique rule the
    rows are first summed by its key, in their tasks before the shuffle, so row checks and
    colliding keys come out of the same groups.
    """
    broken: dict[str, Column] = {}
    unique = None
    for number, rule in enumerate(rules):
        if isinstance(rule, Check):
            broken[rule.name] = is_false(rule.condition)
        elif isinstance(rule, ForeignKey):
            has = f"_has_{number}"
            parents = tables[rule.parent].select(F.col(rule.parent_key).alias(rule.key))
            df = flagged(df, parents, [rule.key], has)
            broken[rule.name] = F.col(rule.key).isNotNull() & ~F.col(has)
        else:
            unique = rule
    totals = {name: F.count(F.when(c, F.lit(1))) for name, c in broken.items()}
    if unique is not None:
        keys = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(unique.keys)]
        grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(name) for name, c in totals.items()])
        whole = reduce(Column.__and__, [F.col(f"_key_{i}").isNotNull() for i in range(len(keys))])
        totals = {name: F.coalesce(F.sum(F.col(f"`{name}`")), F.lit(0)) for name in broken}
        totals[unique.name] = F.count(F.when(whole & (F.col("_n") > 1), F.lit(1)))
        df = grouped
    counts = [
        F.struct(F.lit(name).alias("rule"), F.lit(table).alias("table_name"), c.alias("violations")) for name, c in totals.items()
    ]
    return df.agg(F.array(*counts).alias("_counts")).select(F.inline("_counts"))


def summary(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule: its name, table and number of violations. Rule names differ.

    All rules of a table are counted in one scan of it (a second Unique rule takes another).
    Uniqueness counts colliding keys, a foreign key counts orphaned rows.
    """
    passes: dict[tuple[str, int], list[Rule]] = {}
    for rule in rules:
        number = 0
        if isinstance(rule, Unique):
            while any(isinstance(r, Unique) for r in passes.get((rule.table, number), [])):
                number += 1
        passes.setdefault((rule.table, number), []).append(rule)
    return reduce(
        DataFrame.unionByName, [_one_pass(tables[table], table, found, tables) for (table, _), found in passes.items()]
    )


def write_checked(df: DataFrame, path: str, batch: str | int, table: str, checks: Sequence[Check]) -> DataFrame:
    """Write ``df`` as a batch (:func:`tallywork.sources.sinks.write_batch`) and count the
    violations of its row checks on the way: (rule, table_name, violations), no second scan.

    A batch that was committed before is not written; its rows are then counted where they lie.
    """
    observed = Observation()
    if write_batch(df.observe(observed, *_counts(checks)), path, batch):
        counts = observed.get
    else:
        there = df.sparkSession.read.schema(df.schema).parquet(f"{path.rstrip('/')}/batch={batch}")
        counts = there.agg(*_counts(checks)).first().asDict()
    rows = [(check.name, table, counts[check.name]) for check in checks]
    return inline_rows(df.sparkSession, rows, "rule string, table_name string, violations bigint")
