"""Key column sets and published output schemas."""

from __future__ import annotations

ENTITY = "global_entity_id"
VENDOR = [ENTITY, "platform_vendor_id"]
PRODUCT = [ENTITY, "platform_product_id"]
SKU = [ENTITY, "platform_vendor_id", "platform_product_id"]
CELL = [ENTITY, "vertical_segment", "city"]  # one market cell

LOOKUP = [ENTITY, "platform_product_id", "demand_alias_id", "supply_alias_id"]
BRIDGE = [ENTITY, "demand_alias_id", "supply_alias_id"]
GROUPS = [ENTITY, "platform_product_id", "side", "alias_product_id"]
METADATA = [
    ENTITY, "alias_product_id", "catalog_master_product_name_alias",
    "product_name_local", "product_name_english", "primary_barcode", "product_image_url",
]

# The vendor table's columns that make up one vendor dimension row.
VENDOR_DIMS = [
    ENTITY, "platform_vendor_id", "vendor_name", "chain_id", "chain_name",
    "vertical_segment", "city", "is_key_partner", "menu_sessions", "gmv_eur", "vps_v11",
]

# Published attribute of a gap slot -> column of the gap row it is taken from.
SLOT_ATTRIBUTES = {
    "alias_product_id": "alias_product_id",
    "product_name_alias": "catalog_master_product_name_alias",
    "product_name_en": "product_name_english",
    "product_name_local": "product_name_local",
    "market_rank": "sku_rank",
    "market_qty_sold": "total_quantity_sold",
    "flat_avg_rev_eur": "flat_avg_revenue_eur",
    "weighted_est_rev_eur": "weighted_est_revenue_eur",
    "num_chains": "num_chains",
    "barcode": "primary_barcode",
    "image_url": "product_image_url",
}

# What is known of a recipient.
PEOPLE = ["uuid", "va_vertical_food", "cd_role", "cd_is_multi_vendor_user"]

GAP_KEYS = [*CELL, "platform_vendor_id", "vendor_name", "vendor_sessions"]


def gap_result_columns(slots: int = 3) -> list[str]:
    """Column order of the final result."""
    return [
        *GAP_KEYS,
        "vendor_gmv_eur",
        *(f"gap{n}_{a}" for n in range(1, slots + 1) for a in SLOT_ATTRIBUTES),
        "total_weighted_est_rev_eur", "pct_of_vendor_gmv", "vps_v11",
        "vendor_active_skus", "mature_threshold", "targeted_usecase1", "targeted_usecase2",
        *PEOPLE,
    ]
