"""The form of a registered query and its comparable output."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.sources.tables import Tables


class Query(NamedTuple):
    """A query on a table set and, where SQL can say it, the equal SQL text."""

    build: Callable[[Tables], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return portable(self.build(Tables(spark, folder)))


def _portable(field: T.StructField):
    c, t = F.col(f"`{field.name}`"), field.dataType
    if isinstance(t, T.DecimalType):
        c = c.cast("double")
    elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
        c = c.cast("bigint")
    elif isinstance(t, T.DateType):
        c = c.cast("string")
    elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.alias(field.name)


def portable(df: DataFrame) -> DataFrame:
    """Types two engines print alike. Operators compute in decimals and dates;
    only the finished result is turned into doubles, 64-bit integers and ISO text."""
    return df.select(*[_portable(f) for f in df.schema.fields])
