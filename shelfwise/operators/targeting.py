"""Outreach flags and recipients."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.columns import CELL, ENTITY, PEOPLE, VENDOR, gap_result_columns
from shelfwise.config import GapParams
from shelfwise.functions import or_default, targeted_usecase1, targeted_usecase2
from shelfwise.session import Stage


def with_targeting(
    pivoted: DataFrame, sku_counts: DataFrame, threshold: DataFrame, params: GapParams
) -> DataFrame:
    """Add active products, the maturity threshold and both flags."""
    score, skus = F.col("vps_v11"), F.col("vendor_active_skus")
    bar, pct = F.col("mature_threshold"), F.col("pct_of_vendor_gmv")
    limits = {
        "min_score": params.min_score,
        "factor": params.maturity_factor,
        "missing": params.missing_threshold,
    }
    return (
        pivoted.join(sku_counts, VENDOR, "left")
        .join(threshold, [ENTITY, "vertical_segment"], "left")
        .select(
            *pivoted.columns,
            or_default(skus, 0).alias("vendor_active_skus"),
            or_default(bar, 0).alias("mature_threshold"),
            targeted_usecase1(
                score, skus, bar, pct, min_pct=params.min_uplift_pct, **limits
            ).alias("targeted_usecase1"),
            targeted_usecase2(score, skus, bar, **limits).alias("targeted_usecase2"),
        )
    )


def with_recipients(targeted: DataFrame, contacts: DataFrame, slots: int = 3) -> DataFrame:
    """One row per vendor, cell and recipient; vendors without a recipient are left out."""
    return targeted.join(contacts, VENDOR).select(*gap_result_columns(slots))


def in_order(result: DataFrame, stage: Stage) -> DataFrame:
    """The result with ``position``, each row's place from 1 by market cell, vendor and recipient.

    Order as data: it holds however the rows are read. Rows are dealt by ranges, sorted there and
    stored; what each range holds is counted, and the counts before it are added. ``stage`` must
    store its tables, as a range dealt twice may be cut elsewhere.
    """
    order = [*CELL, "platform_vendor_id", "vendor_name", "uuid", *(c for c in PEOPLE if c != "uuid")]
    ranged = stage("in_order", result.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    counts = ranged.groupBy("_part").agg(F.min("_row").alias("_low"), F.count("*").alias("_n")).select(
        "_part", (or_default(F.sum("_n").over(before), 0) - F.col("_low") + 1).alias("_shift"))
    return ranged.join(counts, "_part").select(
        *result.columns, (F.col("_row") + F.col("_shift")).alias("position"))
