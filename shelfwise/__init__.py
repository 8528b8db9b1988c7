"""Assortment-gap analytics on Spark."""

from shelfwise.config import PLATFORMS, GapParams, Period
from shelfwise.plans import (
    build_lookups, refresh_lookups, sku_gap, sku_gap_platforms,
)
from shelfwise.session import configure, lazy, run_stages, table_stage
from shelfwise.sources import Lookups, Sources, read_result, write_lookups, write_result

__all__ = [
    "PLATFORMS", "GapParams", "Lookups", "Period", "Sources", "build_lookups", "configure",
    "lazy", "read_result", "refresh_lookups", "run_stages", "sku_gap", "sku_gap_platforms", "table_stage", "write_lookups",
    "write_result",
]
