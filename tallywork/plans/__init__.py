"""Queries over the supplied tables: each operator bound to data, with the SQL it must equal."""

from __future__ import annotations

from tallywork.plans import changes, checks, rental, reports, sql_reports, trends
from tallywork.plans.query import Query


def registered() -> dict[str, Query]:
    """All queries by name, in name order."""
    found: dict[str, Query] = {}
    for module in (reports, trends, rental, changes, checks, sql_reports):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"two queries are named {name}")
            found[name] = query
    return dict(sorted(found.items()))
