"""The gap job: which best sellers of its market each vendor lacks, and what they are worth."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import sources
from shelfwise.columns import ENTITY, VENDOR
from shelfwise.config import PLATFORMS, GapParams, Period
from shelfwise.functions import platform_of
from shelfwise.operators import assortment, demand, gaps, targeting, vendors
from shelfwise.plans.refresh import build_lookups
from shelfwise.session import Stage, configure, table_stage
from shelfwise.sources import Lookups, Sources


def inline_lookups(src: Sources, entities, stage: Stage) -> Lookups:
    """The alias tables' relations for one run, without stored lookup tables."""
    built = build_lookups(src, entities, stage)
    return Lookups(built.lookup, stage("bridge", built.bridge), built.metadata)


def sku_gap(
    src: Sources,
    params: GapParams,
    lookups: Lookups | None = None,
    stage: Stage | None = None,
    ordered: bool = False,
) -> DataFrame:
    """One row per vendor, market cell and recipient, with the vendor's best gaps side by side.

    ``lookups`` are the stored alias tables; without them they are built for this run. ``stage``
    says where intermediate tables go; by default, to the session's checkpoint folder. ``ordered``
    adds a column ``position``.
    """
    spark = configure(src.orders.sparkSession)
    stage = stage or table_stage(spark)
    entities, period = params.entities, params.period
    tables = lookups.only(entities) if lookups else inline_lookups(src, entities, stage)

    dims = vendors.vendor_dims(sources.vendor_month(src, period.report_month, entities))
    faces = stage("vendors", vendors.vendor_faces(dims))

    # Both fact tables, read once and reduced to one row per active product of a known vendor; then
    # dealt out by product once, for the groups of both aliases.
    activity = stage("activity", _activity(src, params, faces))
    groups = stage(
        "vendor_groups",
        assortment.vendor_groups(assortment.in_groups(activity, tables.product_groups())),
        by=("side",),
    )
    carried = assortment.carried_groups(groups)

    top = stage("top_products", _top_products(params, groups, carried, faces, tables, stage))
    wanted = demand.bridged(top.select(*demand.GROUP), tables.bridge)
    held = gaps.holders(carried, faces, wanted)

    ranked = _ranked_gaps(params, top, held, carried, faces)
    shown = gaps.with_metadata(ranked, gaps.display_of(top, tables.metadata))
    targeted = targeting.with_targeting(
        gaps.pivot_gaps(shown, params.gaps_per_vendor),
        assortment.vendor_sku_count(activity),
        sources.sku_threshold(src),
        params,
    )
    contacts = vendors.vendor_contacts(
        vendors.vendor_user_links(sources.vendor_users(src), entities),
        sources.comms_attributes(src),
    )
    result = targeting.with_recipients(targeted, contacts, params.gaps_per_vendor)
    return targeting.in_order(result, stage) if ordered else result


def sku_gap_platforms(
    src: Sources, period: Period, lookups: Lookups | None = None,
    stage: Stage | None = None, platforms=tuple(PLATFORMS), **changes,
) -> DataFrame:
    """Several market presets in one job, each row tagged with its preset.

    Every step is keyed by market, so this equals one run per preset but reads the facts once. Write
    it with ``by=("platform",)``, and who reads one preset reads nothing of the others.
    """
    markets = tuple(chain.from_iterable(PLATFORMS[p] for p in platforms))
    params = GapParams(period=period, entities=markets, **changes)
    result = sku_gap(src, params, lookups, stage)
    return result.select(platform_of(F.col(ENTITY)).alias("platform"), *result.columns)


def _activity(src: Sources, params: GapParams, faces: DataFrame) -> DataFrame:
    period = params.period
    rates = sources.active_window_rates(
        src, period.active_from, period.active_to, params.entities
    )
    items = sources.order_items(
        src, period.orders_from, period.orders_to, params.entities, params.order_vertical_exclude
    )
    # Facts of other vendors go as they are read. Spark sends the vendor keys to every executor if
    # their stored size allows; else both sides are dealt by vendor, which the sums then reuse.
    known = faces.select(*VENDOR).distinct()
    return assortment.sku_activity(
        assortment.of_vendors(rates, known), assortment.of_vendors(items, known)
    )


def _top_products(params, groups, carried, faces, tables: Lookups, stage: Stage) -> DataFrame:
    sales = demand.in_market(demand.vendor_group_sales(groups), vendors.vendor_presence(faces))
    passed = demand.quality_gate(
        demand.market_metrics(sales), params.min_avg_revenue, params.min_avg_qty
    )
    chains = stage("chains", demand.carrying_chains(carried, faces))
    pairs = stage("carried_products", demand.carried_products(passed, tables.bridge, chains))
    candidates = demand.in_chains(demand.chain_counts(pairs, chains), params.min_chains)
    return demand.rank_top(candidates, params.top_products)


def _ranked_gaps(params, top, held, carried, faces) -> DataFrame:
    pairs = gaps.top_to_vendors(top, assortment.stocked_shops(faces, carried))
    missing = gaps.drop_carried(pairs, held)
    return gaps.rank_gaps(gaps.priced(missing), params.gaps_per_vendor)
