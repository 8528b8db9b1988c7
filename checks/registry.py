"""One query per operator, over the stand-in inputs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.standin import (
    END, PARAMS, PERIOD, REPORT_MONTH, START, THREE_WINDOWS, StandIn, standin,
)
from shelfwise import GapParams, sku_gap, sku_gap_platforms, sources
from shelfwise import functions as fn
from shelfwise.columns import BRIDGE, CELL, ENTITY, LOOKUP, METADATA, SKU, VENDOR, VENDOR_DIMS
from shelfwise.config import previous_month
from shelfwise.operators.alias import DEMAND, SUPPLY
from shelfwise.operators import (
    alias, assortment, demand, gaps, nested, reports, targeting, vendors,
)


TOTALS = ("menu_sessions", "gmv_eur", "vps_v11")


class Steps:
    """The relations of the job over one stand-in, made by the functions that the job calls."""

    def __init__(self, s: StandIn):
        self.s = s

    @cached_property
    def owner(self):
        return alias.latest_catalog_rows(sources.catalog_products(self.s))

    @cached_property
    def demand_alias(self):
        return sources.alias_demand(self.s)

    @cached_property
    def supply_alias(self):
        return sources.alias_supply(self.s)

    @cached_property
    def pairs_of_aliases(self):
        return alias.alias_pairs(self.demand_alias, self.supply_alias)

    @cached_property
    def bridge(self):
        return self.s.lookups.bridge

    @cached_property
    def metadata(self):
        return self.s.lookups.metadata

    @cached_property
    def product_groups(self):
        return self.s.lookups.product_groups()

    @cached_property
    def month(self):
        return sources.vendor_month(self.s, REPORT_MONTH)

    @cached_property
    def dims(self):
        return vendors.vendor_dims(self.month)

    @cached_property
    def totals(self):
        return vendors.vendor_totals(self.dims)

    @cached_property
    def faces(self):
        return self.s.stored("steps-vendors", vendors.vendor_faces(self.dims))

    @cached_property
    def presence(self):
        return vendors.vendor_presence(self.faces)

    @cached_property
    def items(self):
        return sources.order_items(self.s, START, END)

    # Stored where the job stores its stages, so that each query does not repeat the job up to it.

    @cached_property
    def everyones(self):
        """What all vendors sell actively, whether or not the job knows them."""
        rates = sources.active_window_rates(self.s, START, END)
        return self.s.stored("steps-activity", assortment.sku_activity(rates, self.items))

    @cached_property
    def activity(self):
        """What known vendors sell actively."""
        return assortment.of_vendors(self.everyones, self.faces)

    @cached_property
    def sku_count(self):
        return assortment.vendor_sku_count(self.everyones)

    @cached_property
    def in_groups(self):
        return assortment.in_groups(self.activity, self.product_groups)

    @cached_property
    def products(self):
        return assortment.demand_products(self.in_groups, vendors.vendor_cells(self.faces))

    @cached_property
    def groups(self):
        return self.s.stored("steps-groups", assortment.vendor_groups(self.in_groups), ("side",))

    @cached_property
    def carried(self):
        return assortment.carried_groups(self.groups)

    @cached_property
    def catalog(self):
        return assortment.in_cells(self.carried, self.faces)

    @cached_property
    def sales(self):
        return demand.vendor_group_sales(self.groups)

    @cached_property
    def sales_in_market(self):
        return demand.in_market(self.sales, self.presence)

    @cached_property
    def metrics(self):
        return demand.market_metrics(self.sales_in_market)

    @cached_property
    def gated(self):
        return demand.quality_gate(self.metrics)

    @cached_property
    def chains(self):
        return self.s.stored("steps-chains", demand.carrying_chains(self.carried, self.faces))

    @cached_property
    def carried_products(self):
        pairs = demand.carried_products(self.gated, self.bridge, self.chains)
        return self.s.stored("steps-carried-products", pairs)

    @cached_property
    def counted(self):
        return demand.chain_counts(self.carried_products, self.chains)

    @cached_property
    def candidates(self):
        return demand.in_chains(self.counted)

    @cached_property
    def top(self):
        return self.s.stored("steps-top", demand.rank_top(self.candidates))

    @cached_property
    def shops(self):
        return assortment.stocked_shops(self.faces, self.carried)

    @cached_property
    def pairs(self):
        return gaps.top_to_vendors(self.top, self.shops)

    @cached_property
    def missing(self):
        wanted = demand.bridged(self.top.select(*demand.GROUP), self.bridge)
        return gaps.drop_carried(self.pairs, gaps.holders(self.carried, self.faces, wanted))

    @cached_property
    def priced(self):
        return gaps.priced(self.missing)

    @cached_property
    def best(self):
        return gaps.rank_gaps(self.priced)

    @cached_property
    def shown(self):
        return gaps.with_metadata(self.best, gaps.display_of(self.top, self.metadata))

    @cached_property
    def wide(self):
        return gaps.pivot_gaps(self.shown)

    @cached_property
    def flagged(self):
        threshold = sources.sku_threshold(self.s)
        return targeting.with_targeting(self.wide, self.sku_count, threshold, PARAMS)

    @cached_property
    def links(self):
        return vendors.vendor_user_links(sources.vendor_users(self.s))

    @cached_property
    def contacts(self):
        return vendors.vendor_contacts(self.links, sources.comms_attributes(self.s))

    @cached_property
    def result(self):
        return targeting.with_recipients(self.flagged, self.contacts)

    @cached_property
    def compliance(self):
        return reports.min_sku_compliance(
            self.dims, self.sku_count, sources.sku_threshold(self.s)
        )


def _euros(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue_eur", fn.in_euros(F.col("revenue_eur")))


def _dates(df: DataFrame) -> DataFrame:
    return df.select(*SKU, "date_ref")


def _scan_lookup_tables(s: StandIn) -> DataFrame:
    tables, none = s.lookups, F.lit(None).cast("bigint")
    parts = [
        tables.lookup.select(
            F.lit("lookup").alias("table_name"), ENTITY, F.col(LOOKUP[1]).alias("id1"),
            F.col(LOOKUP[2]).alias("id2"), F.col(LOOKUP[3]).alias("id3"),
        ),
        tables.bridge.select(
            F.lit("bridge").alias("table_name"), ENTITY, F.col(BRIDGE[1]).alias("id1"),
            F.col(BRIDGE[2]).alias("id2"), none.alias("id3"),
        ),
        tables.metadata.select(
            F.lit("metadata").alias("table_name"), ENTITY, F.col(METADATA[1]).alias("id1"),
            none.alias("id2"), none.alias("id3"),
        ),
    ]
    return reduce(DataFrame.union, parts)


def _lookup_refresh(s: StandIn) -> DataFrame:
    tables = s.lookups
    parts = []
    for name, key in (
        ("lookup", "demand_alias_id"), ("bridge", "demand_alias_id"),
        ("metadata", "alias_product_id"),
    ):
        counts = getattr(tables, name).groupBy(ENTITY).agg(
            F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_ids")
        )
        parts.append(counts.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.union, parts)


def _qualify(x: Steps) -> DataFrame:
    best = Window.partitionBy(*CELL).orderBy(
        F.col("gmv_eur").desc_nulls_last(), "platform_vendor_id"
    )
    ranked = x.dims.withColumn("turnover_rank", F.row_number().over(best).cast("bigint"))
    return ranked.where("turnover_rank <= 5").select(
        *CELL, "platform_vendor_id", "gmv_eur", "turnover_rank"
    )


def _vendor_expr(s: StandIn, *columns) -> DataFrame:
    return s.vendor_month.select(*VENDOR, "report_month", *columns)


def _date_arith(s: StandIn) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return s.raw("orders").select(
        "o_orderkey",
        fn.month_start(day).alias("month_start"),
        fn.previous_month_start(day).alias("previous_month"),
        fn.days_before(day, 29).alias("window_start"),
    )


# name -> function of (stand-in, steps)
_QUERIES: dict[str, Callable[[StandIn, Steps], DataFrame]] = {
    "scan_alias_demand": lambda s, x: sources.alias_demand(s),
    "scan_alias_supply": lambda s, x: sources.alias_supply(s),
    "scan_catalog": lambda s, x: sources.catalog_products(s).select(
        ENTITY, "catalog_master_product_id", "platform_product_id",
        F.unix_timestamp("master_product_created_at_utc").alias("created_second"),
    ),
    "scan_vendor_month": lambda s, x: x.month,
    "scan_buyable_rate": lambda s, x: sources.active_window_rates(s.by_month, START, END),
    "scan_orders": lambda s, x: sources.order_items(s.by_month, START, END),
    "scan_vendor_users": lambda s, x: nested.unnest_vendor_nodes(sources.vendor_users(s)),
    "scan_comms_attributes": lambda s, x: sources.comms_attributes(s),
    "scan_sku_threshold": lambda s, x: sources.sku_threshold(s),
    "scan_lookup_tables": lambda s, x: _scan_lookup_tables(s),
    "build_product_alias_lookup": lambda s, x: s.lookups.lookup,
    "build_demand_supply_bridge": lambda s, x: s.lookups.bridge,
    "build_product_metadata": lambda s, x: s.lookups.metadata,
    "write_gap_result": lambda s, x: s.gap_result,
    "filter_entity_in": lambda s, x: _all_months(
        fn.by_entities(s.vendor_month, ["GV_ES", "GV_IT"])
    ),
    "filter_entity_prefix": lambda s, x: fn.by_prefix(x.demand_alias, "GV_%"),
    "filter_no_entity": lambda s, x: _all_months(fn.by_entities(s.vendor_month, None)),
    "filter_report_month": lambda s, x: _all_months(
        fn.in_month(s.vendor_month, date(1999, 11, 1))
    ),
    "filter_previous_month": lambda s, x: _all_months(
        fn.in_month(s.vendor_month, previous_month(date(2000, 1, 15)))
    ),
    "filter_date_range": lambda s, x: _dates(fn.between(s.buyable_rate, "date_ref", START, END)),
    "filter_rolling_30d": lambda s, x: _dates(
        fn.rolling(s.buyable_rate, "date_ref", date(1998, 6, 30))
    ),
    "filter_not_dark": lambda s, x: _all_months(fn.not_dark(s.vendor_month)),
    "filter_not_key_partner": lambda s, x: _all_months(fn.non_key(s.vendor_month)),
    "filter_online": lambda s, x: _all_months(fn.online(s.vendor_month)),
    "filter_successful_orders": lambda s, x: fn.successful(s.orders).select(
        *VENDOR, "order_created_date_lt"
    ),
    "filter_vertical_type": lambda s, x: fn.exclude_vertical(s.orders, "darkstores").select(
        *VENDOR, "vertical_type"
    ),
    "filter_soft_deleted": lambda s, x: fn.alive(
        nested.unnest_vendor_nodes(sources.vendor_users(s)), "is_deleted", "node_is_deleted"
    ),
    "filter_not_null_keys": lambda s, x: fn.require(
        nested.unnest_catalog(s.catalog), "catalog_master_product_id", "platform_product_id"
    ).drop("master_product_created_at_utc"),
    "filter_primary_product": lambda s, x: fn.primary_rows(x.demand_alias),
    "filter_has_vertical_food": lambda s, x: x.contacts,
    "project_rename": lambda s, x: s.demand_alias.select(
        ENTITY, "alias_product_id",
        F.col("primary_name_local").alias("product_name_local"),
        F.col("primary_name_english").alias("product_name_english"),
        F.col("primary_image_url").alias("product_image_url"),
    ),
    "unnest_catalog": lambda s, x: nested.unnest_catalog(s.catalog).drop(
        "master_product_created_at_utc"
    ),
    "unnest_order_items": lambda s, x: nested.order_lines(s.orders),
    "unnest_vendor_nodes_outer": lambda s, x: nested.unnest_vendor_nodes(s.vendor_users),
    "struct_field_access": lambda s, x: s.orders.select(F.explode(fn.field("items.value_euro.total_amt_paid_eur")).alias("total_amt_paid_eur")),
    "join_catalog_alias_left": lambda s, x: alias.product_lookup(x.owner, x.pairs_of_aliases),
    "join_catalog_alias_inner": lambda s, x: _side(x.product_groups, DEMAND),
    "join_bridge": lambda s, x: alias.matched_pairs(x.pairs_of_aliases),
    "join_vendor_catalog": lambda s, x: assortment.in_cells(
        _side(x.in_groups, SUPPLY).select(*SKU, "alias_product_id"), x.faces
    ),
    "join_vendor_demand_products": lambda s, x: x.products,
    "join_order_items": lambda s, x: _euros(demand.item_sums(x.items).join(x.products, SKU)),
    "join_sales_sessions": lambda s, x: _euros(x.sales_in_market),
    "join_candidates_chain": lambda s, x: demand.carriers(x.gated, x.bridge, x.catalog).select(
        *demand.GROUP, "supply_alias_id", "platform_vendor_id", "chain_id"
    ),
    "join_top_to_vendors": lambda s, x: x.pairs.drop(*TOTALS),
    "join_vendor_context": lambda s, x: gaps.priced(x.pairs),
    "antijoin_gap": lambda s, x: x.missing.drop(*TOTALS),
    "join_metadata": lambda s, x: x.shown,
    "join_targeting": lambda s, x: x.result,
    "distinct_vendor_dims": lambda s, x: x.dims,
    "agg_vendor_sessions": lambda s, x: x.totals.select(*VENDOR, "menu_sessions"),
    "agg_vendor_gmv_score": lambda s, x: x.totals.select(*VENDOR, "gmv_eur", "vps_v11"),
    "agg_active_skus": lambda s, x: x.everyones.select(*SKU),
    "agg_vendor_sku_count": lambda s, x: x.sku_count,
    "distinct_vendor_catalog": lambda s, x: x.catalog,
    "distinct_vendor_demand_products": lambda s, x: x.products.distinct(),
    "distinct_bridge": lambda s, x: alias.demand_supply_bridge(x.pairs_of_aliases),
    "distinct_metadata": lambda s, x: alias.product_metadata(s.demand_alias),
    "distinct_vendors_by_dim": lambda s, x: x.shops.select(
        *CELL, "platform_vendor_id", "vendor_name"
    ),
    "distinct_vendor_users": lambda s, x: x.links,
    "agg_vendor_product_sales": lambda s, x: _euros(
        demand.vendor_product_sales(x.items, x.products)
    ),
    "agg_market_metrics": lambda s, x: x.metrics,
    # The default limits hardly bite on this data.
    "having_quality_gate": lambda s, x: demand.quality_gate(x.metrics, 60000, 20),
    "agg_chain_count": lambda s, x: x.counted,
    "having_private_label": lambda s, x: x.candidates,
    "pivot_top3": lambda s, x: x.wide,
    "agg_total_gap_revenue": lambda s, x: x.wide.select(
        *CELL, "platform_vendor_id", fn.round2(gaps.gap_total()).alias("total_weighted_est_rev_eur")
    ),
    "agg_pct_of_gmv": lambda s, x: x.wide.select(
        *CELL, "platform_vendor_id",
        gaps.pct_of_gmv(gaps.gap_total(), F.col("vendor_gmv_eur")).alias("pct_of_vendor_gmv"),
    ),
    "dedup_latest_catalog": lambda s, x: x.owner,
    "rank_top10": lambda s, x: x.top,
    "rank_gap_top3": lambda s, x: x.best,
    "qualify": lambda s, x: _qualify(x),
    "order_result": lambda s, x: targeting.in_order(s.gap_result, s.stored),
    "safe_divide": lambda s, x: _vendor_expr(s, fn.safe_divide(
        F.col("gmv_eur"), fn.or_default(F.col("menu_sessions"), 0)
    ).alias("gmv_per_session")),
    "coalesce_default": lambda s, x: _vendor_expr(
        s,
        fn.or_default(F.col("menu_sessions"), 0).alias("menu_sessions"),
        fn.or_default(F.col("is_key_partner"), False).alias("is_key_partner"),
        fn.or_default(F.col("chain_id"), 999999).alias("chain_id"),
    ),
    "round2": lambda s, x: nested.order_lines(s.orders).select(
        *SKU, fn.round2(F.col("total_amt_paid_eur")).alias("paid_eur")
    ),
    "lower_not_like": lambda s, x: _vendor_expr(
        s, fn.lower_not_like(F.col("vertical"), "dark").alias("is_shop")
    ),
    "case_when": lambda s, x: _vendor_expr(
        s,
        F.when((F.col("vps_v11") >= 50) & (F.col("gmv_eur") > 0), True)
        .otherwise(False).alias("healthy"),
        F.when(F.col("vertical_segment") == "kiosk", F.col("menu_sessions"))
        .alias("kiosk_sessions"),
    ),
    "date_arith": lambda s, x: _date_arith(s),
    "weighted_est_revenue": lambda s, x: x.missing.select(
        *CELL, "platform_vendor_id", "alias_product_id",
        fn.weighted_est_revenue(F.col("rev_per_session"), F.col("menu_sessions"))
        .alias("weighted_est_revenue_eur"),
    ),
    "targeted_usecase1": lambda s, x: x.flagged.select(
        *CELL, "platform_vendor_id", "targeted_usecase1"
    ),
    "targeted_usecase2": lambda s, x: x.flagged.select(
        *CELL, "platform_vendor_id", "targeted_usecase2"
    ),
    "lookup_refresh": lambda s, x: _lookup_refresh(s),
    "gap_v1": lambda s, x: sku_gap(s, GapParams.preset("py", THREE_WINDOWS), s.lookups),
    "gap_platform_preset": lambda s, x: sku_gap_platforms(s, PERIOD, s.lookups),
    "gap_all": lambda s, x: sku_gap(s, PARAMS, s.lookups),
    "gap_v2": lambda s, x: sku_gap(
        s, GapParams.preset("gv", PERIOD, order_vertical_exclude="darkstores")
    ),
    "report_opportunity_by_entity": lambda s, x: reports.opportunity_by_entity(s.gap_result),
    "report_opportunity_by_platform": lambda s, x: reports.opportunity_by_platform(s.gap_result),
    "report_opportunity_share": lambda s, x: reports.opportunity_share(s.gap_result, x.month),
    "report_gmv_by_partner_type": lambda s, x: reports.gmv_by_partner_type(x.month),
    "report_min_sku_compliance": lambda s, x: x.compliance,
    "report_compliance_extremes": lambda s, x: reports.compliance_extremes(x.compliance),
    "email_payload": lambda s, x: reports.email_payload(s.gap_result),
}


_STEPS: dict[StandIn, Steps] = {}


def _side(groups: DataFrame, side: str) -> DataFrame:
    return assortment.on_side(groups, side)


def _all_months(rows: DataFrame) -> DataFrame:
    """Vendor rows with the columns of a vendor scan."""
    return rows.select(*VENDOR_DIMS, "vertical", "is_online")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            s = standin(spark, sf_dir)
            if s not in _STEPS:
                _STEPS[s] = Steps(s)
            return build(s, _STEPS[s])

        return run

    return {name: bind(build) for name, build in _QUERIES.items()}
