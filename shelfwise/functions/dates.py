"""Date arithmetic on columns. The run date is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def previous_month_start(day: Column) -> Column:
    return F.trunc(F.add_months(day, -1), "MM")


def days_before(day: Column, days: int) -> Column:
    return F.date_sub(day, days)
