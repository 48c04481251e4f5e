"""Column expressions: money, labels, names and periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Operand type for ratios: narrow enough that Spark keeps 14 decimals in a quotient.
RATIO_OPERAND = T.DecimalType(20, 2)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Exact two-decimal amount; sums of it do not depend on the order of addition."""
    return as_column(c).cast(MONEY)


def share_of(part: Column | str, total: Column | str) -> Column:
    """100 * part / total, unrounded, as a decimal with 14 fractional digits."""
    return (as_column(part).cast(RATIO_OPERAND) * F.lit(100)) / as_column(total).cast(RATIO_OPERAND)


def half_up_int(c: Column) -> Column:
    """Number to integer with rounding; a plain cast would truncate."""
    return F.round(c, 0).cast("int")


def days_between(later: Column, earlier: Column) -> Column:
    """Length of the interval in days as an exact decimal (half days stay halves)."""
    seconds = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return seconds.cast("decimal(18,0)") / F.lit(86400).cast("decimal(6,0)")


def full_address(address: Column | str, address2: Column | str) -> Column:
    """``address || ' ' || address2`` where a missing second line is empty."""
    return F.concat(as_column(address), F.lit(" "), F.coalesce(as_column(address2), F.lit("")))


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name; NULL when either is NULL (``concat_ws`` would skip it)."""
    return F.concat(as_column(first), F.lit(" "), as_column(last))


def principal_name(first: Column | str, last: Column | str) -> Column:
    return F.concat(F.lit("client_"), F.lower(as_column(first)), F.lit("_"), F.lower(as_column(last)))


def amount_text(c: Column | str) -> Column:
    """Whole amount with thousands separators, padded to 14 characters, then ``$``."""
    return F.concat(F.lpad(F.format_number(F.round(as_column(c), 0), 0), 14, " "), F.lit("$"))


def percent_text(c: Column | str) -> Column:
    return F.concat(as_column(c).cast("string"), F.lit("%"))


def trimmed_percent_text(c: Column | str, scale: int = 4) -> Column:
    """Up to ``scale`` decimals, trailing zeros dropped, the decimal point kept."""
    return F.concat(F.regexp_replace(F.format_number(as_column(c), scale), "0+$", ""), F.lit("%"))


def month_end(c: Column | str) -> Column:
    return F.last_day(as_column(c))


def quarter_label(c: Column | str) -> Column:
    return F.date_format(as_column(c), "yyyy 'Q'Q")


def quarter_range(year: int, quarter: int) -> tuple[dt.datetime, dt.datetime]:
    """Half-open bounds of a quarter. Comparing a column with them reaches the
    Parquet scan; ``year(c) = y AND quarter(c) = q`` would not."""
    start = dt.datetime(year, 3 * quarter - 2, 1)
    end = dt.datetime(year + 1, 1, 1) if quarter == 4 else dt.datetime(year, 3 * quarter + 1, 1)
    return start, end


def instant(value: dt.date | dt.datetime) -> Column:
    """A Python date or datetime as a zone-free timestamp literal."""
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def within(c: Column | str, start: dt.date | dt.datetime, end: dt.date | dt.datetime) -> Column:
    """start <= c < end."""
    c = as_column(c)
    return (c >= instant(start)) & (c < instant(end))
