"""Row filters. Each takes and returns a DataFrame and pushes down to the scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.columns import ENTITY
from shelfwise.functions.scalars import lower_not_like


def by_entities(df: DataFrame, entities: Iterable[str] | None, column: str = ENTITY) -> DataFrame:
    """Keep the given markets; ``None`` keeps all rows, NULL markets included."""
    return df if entities is None else df.where(F.col(column).isin(*entities))


def by_prefix(df: DataFrame, pattern: str, column: str = ENTITY) -> DataFrame:
    """SQL LIKE, in which ``_`` stands for any one character."""
    return df.where(F.col(column).like(pattern))


def in_month(df: DataFrame, month: date, column: str = "report_month") -> DataFrame:
    return df.where(F.col(column) == F.lit(month))


def between(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Both ends included. A table may be partitioned by the date, or by its month in a column
    ``<column>_month`` that holds the month's first day; either way other partitions are skipped."""
    month = f"{column}_month"
    if month in df.columns:
        df = df.where(F.col(month).between(F.lit(start.replace(day=1)), F.lit(end)))
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def rolling(df: DataFrame, column: str, as_of: date, days: int = 30) -> DataFrame:
    """The ``days`` days that end on ``as_of``."""
    return between(df, column, as_of - timedelta(days=days - 1), as_of)


def not_dark(df: DataFrame) -> DataFrame:
    """Drop dark stores, and rows that do not say what they are."""
    return df.where(lower_not_like(F.col("vertical"), "dark"))


def non_key(df: DataFrame) -> DataFrame:
    """Keep vendors not known to be key partners: FALSE and NULL."""
    return df.where("is_key_partner IS NOT TRUE")


def online(df: DataFrame) -> DataFrame:
    return df.where("is_online IS TRUE")


def successful(df: DataFrame) -> DataFrame:
    return df.where("is_successful IS TRUE")


def exclude_vertical(df: DataFrame, vertical: str | None) -> DataFrame:
    """Drop one order vertical, and with it orders of unknown vertical; ``None`` drops nothing."""
    return df if vertical is None else df.where(F.col("vertical_type") != vertical)


def alive(df: DataFrame, *flags: str) -> DataFrame:
    """Drop rows whose deletion flag is set; NULL counts as not deleted."""
    for flag in flags:
        df = df.where(~F.coalesce(F.col(flag), F.lit(False)))
    return df


def require(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def primary_rows(alias: DataFrame) -> DataFrame:
    """The row of each alias group that gave the group its id."""
    return alias.where(F.col("catalog_master_product_id") == F.col("alias_product_id"))
