"""Scans: the columns and rows a job needs from each input, in flat form.

Every scan names its columns and filters first, so column pruning (nested fields included),
pushed filters and partition pruning reach the reader.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.columns import ENTITY, SKU, VENDOR_DIMS
from shelfwise.functions import (
    between, by_entities, exclude_vertical, in_month, require, successful,
)
from shelfwise.operators.nested import order_lines, unnest_catalog
from shelfwise.sources.tables import Sources

_ALIAS = [ENTITY, "catalog_master_product_id", "alias_product_id"]


def alias_demand(src: Sources, entities=None) -> DataFrame:
    """Conservative alias: product -> group."""
    return by_entities(src.demand_alias, entities).select(*_ALIAS)


def alias_supply(src: Sources, entities=None) -> DataFrame:
    """Aggressive alias: product -> group."""
    return by_entities(src.supply_alias, entities).select(*_ALIAS)


def catalog_products(src: Sources, entities=None) -> DataFrame:
    """One row per platform product listed under a master product."""
    rows = unnest_catalog(by_entities(src.catalog, entities))
    return require(rows, "catalog_master_product_id", "platform_product_id")


def vendor_month(src: Sources, month: date, entities=None) -> DataFrame:
    """Vendor rows of one month."""
    rows = in_month(by_entities(src.vendor_month, entities), month)
    return rows.select(*VENDOR_DIMS, "vertical", "is_online")


def active_window_rates(src: Sources, start: date, end: date, entities=None) -> DataFrame:
    """Daily availability of each vendor's products inside a window."""
    rows = between(by_entities(src.buyable_rate, entities), "date_ref", start, end)
    return rows.select(*SKU, "daily_buyable_rate_eligible_ref")


def order_items(
    src: Sources, start: date, end: date, entities=None, vertical_exclude: str | None = None
) -> DataFrame:
    """Items of successful orders inside a window."""
    rows = between(by_entities(src.orders, entities), "order_created_date_lt", start, end)
    return order_lines(exclude_vertical(successful(rows), vertical_exclude))


def vendor_users(src: Sources) -> DataFrame:
    return src.vendor_users.select("user_id", "is_deleted", "vendors")


def comms_attributes(src: Sources) -> DataFrame:
    return src.comms_attributes.select(
        "uuid", "va_vertical_food", "cd_role", "cd_is_multi_vendor_user"
    )


def sku_threshold(src: Sources) -> DataFrame:
    return src.sku_threshold.select(ENTITY, "vertical_segment", "mature_threshold")
