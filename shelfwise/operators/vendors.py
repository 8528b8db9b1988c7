"""Vendor dimensions, vendor totals and the people behind a vendor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.columns import CELL, VENDOR, VENDOR_DIMS
from shelfwise.functions import alive, by_entities, non_key, not_dark, online, or_default
from shelfwise.operators.nested import unnest_vendor_nodes


def vendor_dims(vendor_rows: DataFrame) -> DataFrame:
    """Distinct dimension rows of vendors that are online, no dark stores and no key partners."""
    kept = online(non_key(not_dark(vendor_rows)))
    return kept.select(*VENDOR_DIMS).distinct()


def _largest(column: str):
    return F.max(or_default(F.col(column), 0)).alias(column)


def vendor_totals(dims: DataFrame) -> DataFrame:
    """Sessions, turnover and score in one pass."""
    return dims.groupBy(*VENDOR).agg(
        _largest("menu_sessions"), _largest("gmv_eur"), _largest("vps_v11")
    )


def vendor_faces(dims: DataFrame) -> DataFrame:
    """Each name, cell and chain of a vendor, beside the vendor's totals.

    All that the later steps ask of a vendor, so they need one small table and no further joins.
    """
    faces = dims.select(*VENDOR, "vendor_name", *CELL[1:], "chain_id").distinct()
    return faces.join(vendor_totals(dims), VENDOR)


def vendor_cells(faces: DataFrame) -> DataFrame:
    """The market cells and chains each vendor belongs to."""
    return faces.select(*VENDOR, *CELL[1:], "chain_id").distinct()


def vendor_presence(faces: DataFrame) -> DataFrame:
    """Each vendor once per market cell, with the number of chains it counts under there."""
    return (
        faces.select(*VENDOR, *CELL[1:], "chain_id", "menu_sessions")
        .distinct()
        .groupBy(*VENDOR, *CELL[1:], "menu_sessions")
        .agg(F.count("*").alias("chain_rows"))
    )


def vendor_shops(faces: DataFrame) -> DataFrame:
    """The market cells and names each vendor appears under, with its totals."""
    return faces.drop("chain_id").distinct()


def vendor_user_links(users: DataFrame, entities=None) -> DataFrame:
    """Distinct links between a user and a vendor, neither of them deleted.

    Without a market list a user without vendors is kept; with one it is not, as its market is
    unknown.
    """
    nodes = alive(unnest_vendor_nodes(users), "is_deleted", "node_is_deleted")
    return by_entities(nodes, entities).select("uuid", "vendor_code", VENDOR[0]).distinct()


def vendor_contacts(links: DataFrame, attributes: DataFrame) -> DataFrame:
    """Users a vendor can be written to: those with a known vertical."""
    return links.join(attributes.where("va_vertical_food IS NOT NULL"), "uuid").select(
        VENDOR[0], F.col("vendor_code").alias("platform_vendor_id"), "uuid",
        "va_vertical_food", "cd_role", "cd_is_multi_vendor_user",
    )
