"""Row policies: which rows of a table a principal may see."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.columns import principal_name
from tallywork.functions.keys import among, flagged


def principal_keys(
    customers: DataFrame, principal: str | Column, *, key: str, first_name: str = "first_name", last_name: str = "last_name"
) -> DataFrame:
    """Key of the customer a principal stands for (``client_first_last``, lower case).

    A name that two customers share stands for neither: the rule fails closed, as a scalar
    subquery with two rows would, and the principal sees no rows.
    """
    who = principal if isinstance(principal, Column) else F.lit(principal)
    named = customers.filter(principal_name(first_name, last_name) == who).select(key)
    return (
        named.agg(F.min(key).alias(key), F.max(key).alias("_other"), F.count(key).alias("_n"))
        .filter((F.col("_n") > 0) & (F.col(key) == F.col("_other")))
        .select(key)
    )


def row_policy(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Only rows whose key is among the allowed keys."""
    return among(df, allowed, [key])


def policy_view(df: DataFrame, customers: DataFrame, name: str, *, key: str, **names: str) -> None:
    """A temporary view ``name`` of the rows of ``df`` that belong to whoever asks.

    The session's user (``current_user()``) is the principal. It is looked up by every query
    on the view, not when the view is made, so one definition serves all users.
    """
    own = principal_keys(customers, F.current_user(), key=key, **names)
    row_policy(df, own, key).createOrReplaceTempView(name)


@dataclass(frozen=True)
class Policy:
    """A permissive policy: rows matching ``predicate``, or with a key in ``keys``."""

    predicate: Column | None = None
    keys: DataFrame | None = None


def policy_union(df: DataFrame, policies: Sequence[Policy], *, key: str) -> DataFrame:
    """Rows that at least one policy admits; with no policy, no rows.

    The key sets of all policies are one set, so the table is scanned once
    however many policies there are.
    """
    keyed = [p.keys.select(key) for p in policies if p.keys is not None]
    admitted = F.lit(False)
    for policy in policies:
        if policy.predicate is not None:
            admitted = admitted | F.coalesce(policy.predicate, F.lit(False))
    if not keyed:
        return df.filter(admitted)
    marked = flagged(df, reduce(DataFrame.unionByName, keyed), [key], "_listed")
    return marked.filter(admitted | F.col("_listed")).drop("_listed")
