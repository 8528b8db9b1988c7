from shelfwise.sources.scans import (
    active_window_rates, alias_demand, alias_supply, catalog_products, comms_attributes,
    order_items, sku_threshold, vendor_month, vendor_users,
)
from shelfwise.sources.tables import (
    INPUTS, Lookups, Sources, read_result, write_lookups, write_result,
)
from shelfwise.sources.versions import Versions

__all__ = [
    "INPUTS", "Lookups", "Sources", "Versions", "active_window_rates", "alias_demand", "alias_supply",
    "catalog_products", "comms_attributes", "order_items", "read_result", "sku_threshold", "vendor_month",
    "vendor_users", "write_lookups", "write_result",
]
