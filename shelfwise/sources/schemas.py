"""Column types the jobs expect of each input, as DDL. Ids may be strings or longs throughout."""

from __future__ import annotations

INPUT_SCHEMAS = {
    "catalog": (
        "global_entity_id string, catalog_master_product_id string, "
        "master_product_created_at_utc timestamp, "
        "vendor_products array<struct<platform_product_id: string>>"
    ),
    "demand_alias": (
        "global_entity_id string, catalog_master_product_id string, alias_product_id string, "
        "catalog_master_product_name_alias string, primary_name_local string, "
        "primary_name_english string, primary_barcode string, primary_image_url string"
    ),
    "supply_alias": (
        "global_entity_id string, catalog_master_product_id string, alias_product_id string"
    ),
    "vendor_month": (
        "global_entity_id string, report_month date, platform_vendor_id string, "
        "vendor_name string, chain_id string, chain_name string, vertical string, "
        "vertical_segment string, city string, is_key_partner boolean, is_online boolean, "
        "menu_sessions bigint, gmv_eur double, vps_v11 double"
    ),
    "buyable_rate": (
        "global_entity_id string, platform_vendor_id string, platform_product_id string, "
        "date_ref date, daily_buyable_rate_eligible_ref double"
    ),
    "orders": (
        "global_entity_id string, platform_vendor_id string, order_created_date_lt date, "
        "is_successful boolean, vertical_type string, "
        "items array<struct<platform_product_id: string, quantity_sold: bigint, "
        "value_euro: struct<total_amt_paid_eur: double>>>"
    ),
    "vendor_users": (
        "user_id string, is_deleted boolean, "
        "vendors array<struct<vendor_id: string, global_entity_id: string, "
        "node_is_deleted: boolean>>"
    ),
    "comms_attributes": (
        "uuid string, va_vertical_food string, cd_role string, cd_is_multi_vendor_user boolean"
    ),
    "sku_threshold": (
        "global_entity_id string, vertical_segment string, mature_threshold double"
    ),
}
