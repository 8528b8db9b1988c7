"""Rebuild of the product-alias tables, run once after the alias tables change."""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfwise import sources
from shelfwise.functions import by_entities
from shelfwise.operators import alias
from shelfwise.session import Stage, configure, lazy, run_stages
from shelfwise.sources import Lookups, Sources, write_lookups


def build_lookups(src: Sources, entities=None, stage: Stage = lazy) -> Lookups:
    """The three relations. The join of the two alias tables feeds two of them; with a ``stage``
    it is computed once, and the rest is not yet computed."""
    demand = sources.alias_demand(src, entities)
    supply = sources.alias_supply(src, entities)
    pairs = stage("alias_pairs", alias.alias_pairs(demand, supply))
    catalog = alias.latest_catalog_rows(sources.catalog_products(src, entities))
    return Lookups(
        alias.product_lookup(catalog, pairs),
        alias.demand_supply_bridge(pairs),
        alias.product_metadata(by_entities(src.demand_alias, entities)),
    )


def refresh_lookups(spark: SparkSession, src: Sources, root: str, keep: int = 2) -> Lookups:
    """Replace the tables under ``root`` in one step and read them back. ``keep`` versions stay."""
    configure(spark)
    with run_stages(spark) as stage:
        write_lookups(build_lookups(src, stage=stage), root, keep)
    return Lookups.from_folder(spark, root)
