"""What each vendor actively sells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.columns import CELL, PRODUCT, SKU, VENDOR
from shelfwise.functions import or_default, sum_money
from shelfwise.operators.alias import DEMAND, SUPPLY
from shelfwise.operators.vendors import vendor_shops


def sku_activity(rates: DataFrame, items: DataFrame) -> DataFrame:
    """Active products with what was sold of each; the sums are NULL where nothing was sold.

    Availability days and order items share their key, so both are summed in one aggregation: each
    fact table is read once, reduced before the shuffle (a key that holds a third of all rows
    included), and never joined row by row.
    """
    rate = F.col("daily_buyable_rate_eligible_ref").cast("double")
    facts = rates.select(*SKU, rate.alias("_rate")).unionByName(
        items.select(
            *SKU,
            "quantity_sold",
            or_default(F.col("total_amt_paid_eur"), 0.0).alias("_paid"),
        ),
        allowMissingColumns=True,
    )
    return (
        facts.groupBy(*SKU)
        .agg(
            F.sum("_rate").alias("_rate"),
            F.count("_paid").alias("items_sold"),
            F.sum("quantity_sold").alias("quantity_sold"),
            sum_money(F.col("_paid")).alias("revenue_eur"),
        )
        .where("_rate > 0")
        .drop("_rate")
    )


def vendor_sku_count(active: DataFrame) -> DataFrame:
    """Active products per vendor. ``active`` has each product once, so a plain count will do."""
    return active.groupBy(*VENDOR).agg(F.count("platform_product_id").alias("vendor_active_skus"))


def in_groups(activity: DataFrame, groups: DataFrame) -> DataFrame:
    """Active products in each of their groups, demand and supply side, with what was sold of them.

    The one join that deals activity out by product. Neither side is shuffled for anything else, so
    adaptive execution can split a product that every vendor sells.
    """
    return activity.join(groups, PRODUCT)


def demand_products(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Active products of known vendors with their demand group, in each cell and chain, from
    ``in_groups``."""
    products = on_side(rows, DEMAND).select(*SKU, "alias_product_id")
    return products.join(cells, VENDOR).select(*products.columns, *CELL[1:], "chain_id")


def vendor_groups(rows: DataFrame) -> DataFrame:
    """Each group of either side at each vendor, with what was sold of it."""
    return rows.groupBy(*VENDOR, "side", "alias_product_id").agg(
        F.sum("items_sold").alias("items_sold"),
        F.sum("quantity_sold").alias("quantity_sold"),
        sum_money(F.col("revenue_eur")).alias("revenue_eur"),
    )


def on_side(groups: DataFrame, side: str) -> DataFrame:
    return groups.where(F.col("side") == side).drop("side")


def carried_groups(groups: DataFrame) -> DataFrame:
    """Supply groups each vendor carries."""
    return on_side(groups, SUPPLY).select(*VENDOR, "alias_product_id")


def in_cells(carried: DataFrame, faces: DataFrame) -> DataFrame:
    """Carried groups under each name, cell and chain of their vendor."""
    return carried.join(faces.select(*VENDOR, "vendor_name", *CELL[1:], "chain_id"), VENDOR)


def of_vendors(df: DataFrame, vendors: DataFrame) -> DataFrame:
    """Rows of the vendors that appear in another relation."""
    return df.join(vendors.select(*VENDOR), VENDOR, "left_semi")


def stocked_shops(faces: DataFrame, carried: DataFrame) -> DataFrame:
    """The cells and names of the vendors that carry anything, with their totals.

    The distinct shrinks the groups to one row per vendor before they are shuffled.
    """
    return of_vendors(vendor_shops(faces), carried.select(*VENDOR).distinct())
