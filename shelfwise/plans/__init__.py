from shelfwise.plans.gap import inline_lookups, sku_gap, sku_gap_platforms
from shelfwise.plans.refresh import build_lookups, refresh_lookups

__all__ = ["build_lookups", "inline_lookups", "refresh_lookups", "sku_gap", "sku_gap_platforms"]
