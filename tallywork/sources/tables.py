"""Readers for the supplied Parquet tables and for inline rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.columns import MONEY

# Amounts that the files hold as double; they are exact decimals from here on.
MONEY_COLUMNS = {
    "customer": ("c_acctbal",),
    "supplier": ("s_acctbal",),
    "part": ("p_retailprice",),
    "orders": ("o_totalprice",),
    "lineitem": ("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    "events": ("value",),
}


def parquet_table(spark: SparkSession, path: str, money: Sequence[str] = ()) -> DataFrame:
    """A Parquet table with the ``money`` columns as decimal(18,2)."""
    df = spark.read.parquet(path)
    return df.withColumns({c: F.col(c).cast(MONEY) for c in money}) if money else df


def inline_rows(spark: SparkSession, rows: Iterable[Sequence[object]], schema: str) -> DataFrame:
    """Rows written in code (a ``VALUES`` list)."""
    return spark.createDataFrame(list(rows), schema)


class Tables:
    """The tables of one data folder, opened when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _open(self, name: str) -> DataFrame:
        return parquet_table(self.spark, f"{self.folder}/{name}.parquet", MONEY_COLUMNS.get(name, ()))

    region = cached_property(lambda self: self._open("region"))
    nation = cached_property(lambda self: self._open("nation"))
    customer = cached_property(lambda self: self._open("customer"))
    supplier = cached_property(lambda self: self._open("supplier"))
    part = cached_property(lambda self: self._open("part"))
    orders = cached_property(lambda self: self._open("orders"))
    lineitem = cached_property(lambda self: self._open("lineitem"))
    events = cached_property(lambda self: self._open("events"))
