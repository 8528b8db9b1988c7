"""Market demand: sales, quality gates, chain spread and the top products of each cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.columns import BRIDGE, CELL, ENTITY, SKU, VENDOR
from shelfwise.functions import in_euros, or_default, safe_divide, sum_money, times
from shelfwise.operators.alias import DEMAND
from shelfwise.operators.assortment import in_cells, on_side

GROUP = [*CELL, "alias_product_id"]  # one demand group in one market cell
CARRIED = [*CELL, "supply_alias_id"]  # one supply group in one market cell


def item_sums(items: DataFrame) -> DataFrame:
    """Order items summed per vendor and product, so hot products shrink before any join."""
    return items.groupBy(*SKU).agg(
        F.sum("quantity_sold").alias("quantity_sold"),
        sum_money(or_default(F.col("total_amt_paid_eur"), 0.0)).alias("revenue_eur"),
    )


def vendor_product_sales(items: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and revenue of each demand group at each vendor, by cell and chain."""
    keys = [*VENDOR, "chain_id", *CELL[1:], "alias_product_id"]
    return item_sums(items).join(products, SKU).groupBy(*keys).agg(
        F.sum("quantity_sold").alias("quantity_sold"),
        sum_money(F.col("revenue_eur")).alias("revenue_eur"),
    )


def vendor_group_sales(groups: DataFrame) -> DataFrame:
    """Quantity and revenue of each demand group at each vendor that sold any of it."""
    return on_side(groups, DEMAND).where("items_sold > 0").drop("items_sold")


def in_market(sales: DataFrame, presence: DataFrame) -> DataFrame:
    """A vendor's sales in each of its cells, with its sessions.

    Cells are attached after the vendor's sums, as they depend on the vendor alone.
    """
    return sales.join(presence, VENDOR)


def market_metrics(rows: DataFrame) -> DataFrame:
    """Demand of each group in each cell, from ``in_market``.

    Sales and sessions count once per chain row, so a vendor that sells under two chains counts
    twice. With each vendor once per cell, and its chain rows as a weight, vendors need no distinct
    count: all is summed before the one shuffle.
    """
    weight = F.col("chain_rows")
    return rows.groupBy(*GROUP).agg(
        *_metrics(
            F.sum(F.col("quantity_sold") * weight),
            sum_money(times(F.col("revenue_eur"), weight)),
            F.count("platform_vendor_id"),
            F.sum(F.col("menu_sessions") * weight),
        )
    )


def _metrics(qty: Column, revenue: Column, vendors: Column, sessions: Column) -> list[Column]:
    return [
        qty.alias("total_quantity_sold"),
        in_euros(revenue).alias("total_revenue_eur"),
        vendors.alias("num_vendors_sold"),
        safe_divide(revenue, vendors).alias("flat_avg_revenue_eur"),
        safe_divide(qty, vendors).alias("flat_avg_qty"),
        safe_divide(revenue, sessions).alias("rev_per_session"),
    ]


def quality_gate(
    metrics: DataFrame, min_avg_revenue: float = 100.0, min_avg_qty: float = 1.0
) -> DataFrame:
    return metrics.where(
        (F.col("flat_avg_revenue_eur") >= min_avg_revenue) & (F.col("flat_avg_qty") > min_avg_qty)
    )


def bridged(products: DataFrame, bridge: DataFrame) -> DataFrame:
    """Every supply group that stands for a product's demand group."""
    pairs = bridge.select(
        BRIDGE[0],
        F.col("demand_alias_id").alias("alias_product_id"),
        F.col("supply_alias_id"),
    )
    return products.join(pairs, [ENTITY, "alias_product_id"])


def carriers(products: DataFrame, bridge: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog rows, in the product's own cell, that carry the product under any supply group."""
    rows = catalog.withColumnRenamed("alias_product_id", "supply_alias_id")
    return bridged(products, bridge).join(rows, [*CELL, "supply_alias_id"])


def carrying_chains(carried: DataFrame, faces: DataFrame) -> DataFrame:
    """The chains that carry each supply group in each cell, each once; NULL for chainless vendors.

    Every vendor of a chain offers the same row, so the distinct shrinks them before the shuffle,
    and it spreads a hot group over its chains.
    """
    rows = in_cells(carried, faces).withColumnRenamed("alias_product_id", "supply_alias_id")
    return rows.select(*CARRIED, "chain_id").distinct()


def carried_products(products: DataFrame, bridge: DataFrame, chains: DataFrame) -> DataFrame:
    """Each supply group that stands for a product and is carried in the product's own cell, with
    the number of chains that carry it. A group's chains are counted once, not once per product."""
    sizes = chains.groupBy(*CARRIED).agg(F.count("chain_id").alias("supply_chains"))
    return bridged(products, bridge).join(sizes, CARRIED)


def chain_counts(pairs: DataFrame, chains: DataFrame) -> DataFrame:
    """``num_chains`` of every product, from ``carried_products``: the exact distinct number of chains
    that carry any of its supply groups in its cell.

    The chains of a product's largest supply group are known by their number. Only those of its
    other groups are listed, and count if they do not carry the largest one. So a supply group that
    merges very many products is not multiplied by its chains, and most products list none.
    """
    own = [c for c in pairs.columns if c not in (*GROUP, "supply_alias_id", "supply_chains")]
    largest = F.max(F.struct("supply_chains", "supply_alias_id"))
    products = pairs.groupBy(*GROUP).agg(
        *(F.any_value(c).alias(c) for c in own), largest.alias("_largest"), F.count("*").alias("_groups")
    )
    several = products.where("_groups > 1").select(
        *GROUP, F.col("_largest.supply_alias_id").alias("_base"))
    others = (
        pairs.select(*GROUP, "supply_alias_id").join(several, GROUP)
        .where("supply_alias_id <> _base")
        .join(chains.where("chain_id IS NOT NULL"), CARRIED)
        .select(*GROUP, "_base", "chain_id").distinct()
    )
    known = chains.withColumnRenamed("supply_alias_id", "_base")
    more = (
        others.join(known, [*CELL, "_base", "chain_id"], "left_anti")
        .groupBy(*GROUP).agg(F.count("*").alias("_more"))
    )
    return products.join(more, GROUP, "left").select(
        *GROUP, *own,
        (F.col("_largest.supply_chains") + or_default(F.col("_more"), 0)).alias("num_chains"),
    )


def in_chains(counted: DataFrame, least: int = 2) -> DataFrame:
    """Products carried by ``least`` chains or more."""
    return counted.where(F.col("num_chains") >= least)


def rank_top(candidates: DataFrame, k: int = 10) -> DataFrame:
    """Best sellers of each cell by rank; ties share a rank, so more than ``k`` may stay.

    The rank filter is applied to every input partition before the shuffle, so a cell that holds a
    third of all candidates sends only its leaders.
    """
    best = Window.partitionBy(*CELL).orderBy(F.col("total_quantity_sold").desc())
    return candidates.withColumn("sku_rank", F.rank().over(best).cast("bigint")).where(
        F.col("sku_rank") <= k
    )
