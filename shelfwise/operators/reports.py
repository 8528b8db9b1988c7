"""Reports over a gap result and over the vendor table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.columns import CELL, ENTITY, GAP_KEYS, VENDOR
from shelfwise.functions import in_euros, platform_of, round2, safe_divide, sum_money

TOTAL = "Total"


def vendor_grain(result: DataFrame, targeted_only: bool = True) -> DataFrame:
    """One row per vendor and cell: recipients repeat a vendor's amounts, which must count once."""
    rows = result.where("targeted_usecase1") if targeted_only else result
    return rows.select(*GAP_KEYS, "total_weighted_est_rev_eur").distinct()


def _opportunity(result: DataFrame, targeted_only: bool) -> DataFrame:
    return vendor_grain(result, targeted_only).select(
        platform_of(F.col(ENTITY)).alias("platform"), ENTITY,
        F.col("total_weighted_est_rev_eur").alias("_eur"),
    )


def opportunity_by_entity(result: DataFrame, targeted_only: bool = True) -> DataFrame:
    """Estimated monthly revenue per market."""
    return (
        _opportunity(result, targeted_only)
        .groupBy("platform", ENTITY)
        .agg(in_euros(sum_money(F.col("_eur"))).alias("estimated_revenue_eur"))
        .orderBy("platform", F.col("estimated_revenue_eur").desc(), ENTITY)
    )


def opportunity_by_platform(result: DataFrame, targeted_only: bool = True) -> DataFrame:
    """Estimated monthly revenue per platform, with the grand total."""
    return (
        _opportunity(result, targeted_only)
        .rollup("platform")
        .agg(
            in_euros(sum_money(F.col("_eur"))).alias("estimated_revenue_eur"),
            F.grouping("platform").alias("_total"),
        )
        .orderBy("_total", "platform")
        .select(_label("platform"), "estimated_revenue_eur")
    )


def _label(column: str):
    return F.when(F.col("_total") == 1, TOTAL).otherwise(F.col(column)).alias(column)


def gmv_per_vendor(vendor_rows: DataFrame) -> DataFrame:
    """Turnover of every vendor of the month, key partners too, each vendor once."""
    return vendor_rows.groupBy(*VENDOR).agg(
        F.coalesce(F.bool_or("is_key_partner"), F.lit(False)).alias("is_key"),
        F.max(F.coalesce("gmv_eur", F.lit(0.0))).alias("gmv_eur"),
    )


def opportunity_share(
    result: DataFrame, vendor_rows: DataFrame, targeted_only: bool = True
) -> DataFrame:
    """Total opportunity against the turnover of small vendors and of all vendors."""
    total = vendor_grain(result, targeted_only).agg(
        F.coalesce(in_euros(sum_money(F.col("total_weighted_est_rev_eur"))), F.lit(0.0)).alias("opp")
    )
    gmv = gmv_per_vendor(vendor_rows).agg(
        in_euros(sum_money(F.when(~F.col("is_key"), F.col("gmv_eur")))).alias("nkp"),
        in_euros(sum_money(F.col("gmv_eur"))).alias("everyone"),
    )
    # One row each: both sides are ungrouped aggregates.
    both = total.withColumn("_one", F.lit(1)).join(gmv.withColumn("_one", F.lit(1)), "_one")
    opp, nkp, everyone = F.col("opp"), F.col("nkp"), F.col("everyone")
    return both.select(
        opp.alias("total_opportunity_eur"),
        round2(safe_divide(opp, nkp) * 100).alias("pct_of_nkp_gmv"),
        round2(safe_divide(opp, everyone) * 100).alias("pct_of_all_gmv"),
        nkp.alias("nkp_gmv_eur"),
        everyone.alias("all_gmv_eur"),
    )


def gmv_by_partner_type(vendor_rows: DataFrame) -> DataFrame:
    """Turnover per platform, split into small vendors and key partners, with a total row."""
    eur, key = F.col("gmv_eur"), F.col("is_key")
    return (
        gmv_per_vendor(vendor_rows)
        .withColumn("platform", platform_of(F.col(ENTITY)))
        .rollup("platform")
        .agg(
            in_euros(sum_money(F.when(key, 0.0).otherwise(eur))).alias("nkp_gmv_eur"),
            in_euros(sum_money(F.when(key, eur).otherwise(0.0))).alias("key_partner_gmv_eur"),
            in_euros(sum_money(eur)).alias("total_gmv_eur"),
            F.grouping("platform").alias("_total"),
        )
        .orderBy("_total", "platform")
        .select(_label("platform"), "nkp_gmv_eur", "key_partner_gmv_eur", "total_gmv_eur")
    )


def min_sku_compliance(
    dims: DataFrame, sku_counts: DataFrame, threshold: DataFrame, factor: float = 0.8,
    missing: int = 999999,
) -> DataFrame:
    """Vendors per market that fall short of the bar in any of their segments.

    Starts from the vendors, so a vendor with nothing active counts as short.
    """
    bar = F.lit(float(factor)) * F.coalesce("mature_threshold", F.lit(missing))
    short = F.coalesce("vendor_active_skus", F.lit(0)) < bar
    vendors = (
        dims.select(*VENDOR, "vertical_segment").distinct()
        .join(sku_counts, VENDOR, "left")
        .join(threshold, [ENTITY, "vertical_segment"], "left")
        .groupBy(*VENDOR)
        .agg(F.bool_or(short).alias("_short"))
    )
    below = F.count_if("_short")
    return (
        vendors.groupBy(ENTITY)
        .agg(
            F.count("*").alias("total_vendors"),
            below.alias("below_threshold"),
            round2(safe_divide(below, F.count("*")) * 100).alias("pct_below"),
        )
        .select(platform_of(F.col(ENTITY)).alias("platform"), "*")
        .orderBy(F.col("pct_below").desc(), ENTITY)
    )


def compliance_extremes(compliance: DataFrame) -> DataFrame:
    """The markets with the highest share, the lowest share and the most vendors below the bar.

    Ties go to the first market by code.
    """
    row = F.struct(ENTITY, "pct_below", "below_threshold")

    def pick(kind: str, order):
        return F.struct(F.lit(kind).alias("kind"), F.min_by(row, order).alias("row"))

    highest = pick("highest_pct", F.struct(-F.col("pct_below"), F.col(ENTITY)))
    lowest = pick("lowest_pct", F.struct(F.col("pct_below"), F.col(ENTITY)))
    most = pick("most_vendors", F.struct(-F.col("below_threshold"), F.col(ENTITY)))
    return compliance.agg(F.array(highest, lowest, most).alias("picks")).select(
        F.inline("picks")
    ).select("kind", "row.*")


def email_payload(result: DataFrame, slots: int = 3) -> DataFrame:
    """Merge fields of the outreach mail, once per targeted vendor and cell."""
    fields = [F.col("total_weighted_est_rev_eur").alias("sum_weighted_est_rev_eur")]
    for n in range(1, slots + 1):
        name = F.coalesce(f"gap{n}_product_name_local", f"gap{n}_product_name_en")
        fields += [
            name.alias(f"product_{n}_name"),
            F.col(f"gap{n}_barcode").alias(f"product_{n}_barcode"),
            F.col(f"gap{n}_image_url").alias(f"product_{n}_image"),
        ]
    return (
        result.where("targeted_usecase1")
        .select(ENTITY, "platform_vendor_id", "vendor_name", *CELL[1:], *fields)
        .distinct()
    )
