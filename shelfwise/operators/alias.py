"""Product-alias relations: product lookup, demand-supply bridge, display metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.columns import BRIDGE, ENTITY, LOOKUP, METADATA, PRODUCT
from shelfwise.functions import primary_rows

MASTER = [ENTITY, "catalog_master_product_id"]
DEMAND, SUPPLY = "demand", "supply"  # the sides of a product group


def latest_catalog_rows(catalog_rows: DataFrame) -> DataFrame:
    """The newest master product of each platform product.

    The rank filter is pushed below the shuffle as a group limit, so one row per product and input
    partition travels, however often a product is listed. Equal dates go to the smaller master id.
    """
    newest = Window.partitionBy(*PRODUCT).orderBy(
        F.col("master_product_created_at_utc").desc_nulls_last(), "catalog_master_product_id"
    )
    return (
        catalog_rows.withColumn("_nth", F.row_number().over(newest))
        .where("_nth = 1")
        .select(*PRODUCT, "catalog_master_product_id")
    )


def alias_pairs(demand: DataFrame, supply: DataFrame) -> DataFrame:
    """Both groups of every master product, either of which may be missing."""
    return _named(demand, "demand_alias_id").join(
        _named(supply, "supply_alias_id"), MASTER, "full_outer"
    )


def matched_pairs(pairs: DataFrame) -> DataFrame:
    """The inner join of the alias tables: master products that both of them list."""
    return pairs.where("demand_alias_id IS NOT NULL AND supply_alias_id IS NOT NULL")


def product_lookup(catalog: DataFrame, pairs: DataFrame) -> DataFrame:
    """Platform product -> demand and supply group; either may be NULL.

    The two alias tables meet first, so the large catalog side is joined once, and a master product
    with very many listings is a hot key of one left join that adaptive execution can split.
    """
    return catalog.join(pairs, MASTER, "left").select(*LOOKUP)


def product_groups(lookup: DataFrame) -> DataFrame:
    """Platform product -> each of its groups, under both aliases, each once: product, side, group.

    One relation for both sides, so that a job which needs both deals its products out once.
    """
    group = F.explode(F.array(*(
        F.struct(F.lit(side).alias("side"), F.col(f"{side}_alias_id").alias("alias_product_id"))
        for side in (DEMAND, SUPPLY)
    )))
    return (
        lookup.select(*PRODUCT, group.alias("_group")).select(*PRODUCT, "_group.*")
        .where("alias_product_id IS NOT NULL").distinct()
    )


def demand_supply_bridge(pairs: DataFrame) -> DataFrame:
    """Demand and supply groups that share a master product, each pair once."""
    return matched_pairs(pairs).select(*BRIDGE).distinct()


def product_metadata(demand: DataFrame) -> DataFrame:
    """Display columns of every group's primary product."""
    return (
        primary_rows(demand)
        .withColumnsRenamed({
            "primary_name_local": "product_name_local",
            "primary_name_english": "product_name_english",
            "primary_image_url": "product_image_url",
        })
        .select(*METADATA)
        .distinct()
    )


def _named(alias: DataFrame, name: str) -> DataFrame:
    return alias.select(*MASTER, F.col("alias_product_id").alias(name))
