"""Gaps: top products of its own cells that a vendor does not carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.columns import CELL, ENTITY, GAP_KEYS, METADATA, SLOT_ATTRIBUTES, VENDOR
from shelfwise.functions import or_default, round2, safe_divide, weighted_est_revenue
from shelfwise.operators.demand import bridged


def top_to_vendors(top: DataFrame, vendors: DataFrame) -> DataFrame:
    """Every top product beside every vendor of the same cell."""
    return top.join(vendors, CELL)


def priced(pairs: DataFrame) -> DataFrame:
    """Price the gap by the sessions of the vendor, whose totals are beside it."""
    sessions = or_default(F.col("menu_sessions"), 0)
    totals = ("menu_sessions", "gmv_eur", "vps_v11")
    return pairs.select(
        *(c for c in pairs.columns if c not in totals),
        sessions.alias("vendor_sessions"),
        weighted_est_revenue(F.col("rev_per_session"), sessions).alias("weighted_est_revenue_eur"),
        or_default(F.col("gmv_eur"), 0).alias("vendor_gmv_eur"),
        or_default(F.col("vps_v11"), 0).alias("vps_v11"),
    )


def holders(carried: DataFrame, faces: DataFrame, wanted: DataFrame) -> DataFrame:
    """Who carries each top product in its own cell: cell, product and vendor.

    ``wanted`` is the handful of bridged top products. It thins the large carried groups by a
    semi-join before cells are attached, so a supply group that is a top product in many cells is
    not multiplied by them.
    """
    rows = carried.withColumnRenamed("alias_product_id", "supply_alias_id").join(
        wanted.select(ENTITY, "supply_alias_id"), [ENTITY, "supply_alias_id"], "left_semi"
    )
    cells = faces.select(*VENDOR, *CELL[1:]).distinct()
    return (
        rows.join(cells, VENDOR).join(wanted, [*CELL, "supply_alias_id"])
        .select(*CELL, "alias_product_id", "platform_vendor_id")
    )


def drop_carried(pairs: DataFrame, carried: DataFrame) -> DataFrame:
    """Keep what the vendor does not carry. A vendor carries the same groups in all its cells."""
    keys = [c for c in carried.columns if c in pairs.columns]
    return pairs.join(carried.select(*keys), keys, "left_anti")


def rank_gaps(gaps: DataFrame, k: int = 3) -> DataFrame:
    """The vendor's best gaps, by market rank and then by product id."""
    best = Window.partitionBy(*CELL, "platform_vendor_id").orderBy(
        "sku_rank", "alias_product_id", "vendor_name"
    )
    return gaps.withColumn("vendor_gap_rank", F.row_number().over(best)).where(
        F.col("vendor_gap_rank") <= k
    )


def with_metadata(gaps: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add display columns."""
    return gaps.join(metadata.select(*METADATA), [ENTITY, "alias_product_id"], "left")


def display_of(top: DataFrame, metadata: DataFrame) -> DataFrame:
    """Display columns of the top products only, one row each.

    A group with several display rows takes the largest value of each column, which is what the
    pivot over them would pick.
    """
    wanted = top.select(ENTITY, "alias_product_id").distinct()
    return (
        metadata.join(wanted, [ENTITY, "alias_product_id"], "left_semi")
        .groupBy(ENTITY, "alias_product_id")
        .agg(*(F.max(c).alias(c) for c in METADATA[2:]))
    )


def gap_total(slots: int = 3) -> Column:
    """Sum of the slot estimates; an empty slot counts as 0."""
    total = F.lit(0.0)
    for n in range(1, slots + 1):
        total = total + or_default(F.col(f"gap{n}_weighted_est_rev_eur"), 0.0)
    return total


def pct_of_gmv(total: Column, gmv: Column) -> Column:
    """Total as a percentage of turnover; NULL without turnover."""
    return round2(safe_divide(total, gmv) * 100)


def pivot_gaps(gaps: DataFrame, slots: int = 3) -> DataFrame:
    """One row per vendor and cell, its gaps side by side, with their sum."""

    def slot(n: int, attribute: str, column: str) -> Column:
        return F.expr(f"max({column}) FILTER (WHERE vendor_gap_rank = {n}) AS gap{n}_{attribute}")

    rounded = gaps.withColumn("flat_avg_revenue_eur", round2(F.col("flat_avg_revenue_eur")))
    wide = rounded.groupBy(*GAP_KEYS).agg(
        F.max("vendor_gmv_eur").alias("vendor_gmv_eur"),
        *(
            slot(n, attribute, column)
            for n in range(1, slots + 1)
            for attribute, column in SLOT_ATTRIBUTES.items()
        ),
        F.max("vps_v11").alias("vps_v11"),
    )
    total = gap_total(slots)
    score = F.col("vps_v11")
    return wide.select(
        *(c for c in wide.columns if c != "vps_v11"),
        round2(total).alias("total_weighted_est_rev_eur"),
        pct_of_gmv(total, F.col("vendor_gmv_eur")).alias("pct_of_vendor_gmv"),
        score,
    )
