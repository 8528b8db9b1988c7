"""Flattening of nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.columns import ENTITY


def unnest_catalog(catalog: DataFrame) -> DataFrame:
    """One row per listed platform product; products without a listing vanish."""
    return catalog.select(
        ENTITY,
        "catalog_master_product_id",
        "master_product_created_at_utc",
        F.explode("vendor_products").alias("vp"),
    ).select(
        ENTITY,
        "catalog_master_product_id",
        "master_product_created_at_utc",
        F.col("vp.platform_product_id").alias("platform_product_id"),
    )


def order_lines(orders: DataFrame) -> DataFrame:
    """One row per order item, with the three fields that the jobs use; orders without items vanish.

    An exploded item struct is read whole as soon as two of its fields are used. Zipping the wanted
    fields first lets the reader skip all others, which in real orders are most of the bytes.
    """
    wanted = F.arrays_zip(
        "items.platform_product_id", "items.quantity_sold", "items.value_euro.total_amt_paid_eur"
    )
    return orders.select(
        ENTITY,
        "platform_vendor_id",
        F.inline(wanted).alias("platform_product_id", "quantity_sold", "total_amt_paid_eur"),
    )


def unnest_vendor_nodes(users: DataFrame) -> DataFrame:
    """One row per user and vendor; a user without vendors stays, with a NULL vendor."""
    return users.select(
        F.col("user_id").alias("uuid"), "is_deleted", F.explode_outer("vendors").alias("node")
    ).select(
        "uuid",
        "is_deleted",
        F.col("node.vendor_id").alias("vendor_code"),
        F.col(f"node.{ENTITY}").alias(ENTITY),
        F.col("node.node_is_deleted").alias("node_is_deleted"),
    )
