"""Reports that SQL can call: temporary table functions and views over DataFrames."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"[a-z_][a-z0-9_]*")


def _checked(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"{name!r} cannot be the name of a function, a view or an argument")
    return name


def define_view(name: str, df: DataFrame) -> None:
    """``SELECT * FROM name`` gives the rows of ``df``, planned together with the asking query."""
    df.createOrReplaceTempView(_checked(name))


def define_table_function(
    spark: SparkSession,
    name: str,
    arguments: Mapping[str, str],
    returns: Mapping[str, str],
    body: str,
    *,
    checks: Mapping[str, str] | None = None,
) -> None:
    """``SELECT * FROM name(...)`` runs ``body``, a query that uses the arguments by name.

    ``arguments`` and ``returns`` map names to types. ``checks`` maps what is wrong to a
    condition on the arguments; where a condition is not true the call fails with that text. Spark inlines the body into the query that calls it, so filters
    made of literal arguments reach the scan.
    """
    given = ", ".join(f"{_checked(a)} {t}" for a, t in arguments.items())
    out = ", ".join(f"{_checked(c)} {t}" for c, t in returns.items())
    query = f"SELECT * FROM ({body})"
    for message, condition in (checks or {}).items():
        # A branch without rows: gone from the plan where the condition holds, an error where not.
        nothing = ", ".join(f"CAST(NULL AS {t})" for t in returns.values())
        text = message.replace("'", "''")
        query += f" UNION ALL SELECT {nothing} FROM VALUES (1) one(x) WHERE IF({condition}, FALSE, raise_error('{text}'))"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {_checked(name)}({given}) RETURNS TABLE({out}) RETURN {query}")
