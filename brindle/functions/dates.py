"""Calendar and clock expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"  # fixed value: validity end of a current row


def month_of(ts: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(ts.cast("date"), "month")


def calendar(day: Column) -> dict[str, Column]:
    """Year, quarter, month, day and full weekday name of a date or timestamp."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.day(day),
        "dayofweek": F.date_format(day, "EEEE"),
    }


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def within_days(ts: Column, as_of: str, days: int) -> Column:
    """`ts` lies at or after `as_of` minus `days`; the bound folds to a literal."""
    return ts >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")


def object_id_time(object_id: Column) -> Column:
    """Creation time held in the first four bytes of a 24-digit hex id."""
    return F.timestamp_seconds(F.conv(F.substring(object_id, 1, 8), 16, 10).cast("bigint"))
