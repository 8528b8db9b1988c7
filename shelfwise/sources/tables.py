"""Input tables, derived lookup tables, and the writers for what a job leaves behind."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from shelfwise.columns import BRIDGE, ENTITY, GROUPS, LOOKUP, METADATA
from shelfwise.functions import by_entities
from shelfwise.operators.alias import product_groups
from shelfwise.sources.versions import Versions


@dataclass(frozen=True)
class Sources:
    """The nine input tables. README lists the columns each must have."""

    catalog: DataFrame
    demand_alias: DataFrame
    supply_alias: DataFrame
    vendor_month: DataFrame
    buyable_rate: DataFrame
    orders: DataFrame
    vendor_users: DataFrame
    comms_attributes: DataFrame
    sku_threshold: DataFrame

    @classmethod
    def from_folder(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> Sources:
        """Each input is a folder under ``root`` named like the field."""
        return cls(**{n: spark.read.format(fmt).load(f"{root}/{n}") for n in INPUTS})

    @classmethod
    def from_tables(cls, spark: SparkSession, names: Mapping[str, str]) -> Sources:
        """Each input is a catalog table, given as field -> table name."""
        return cls(**{n: spark.table(names[n]) for n in INPUTS})


INPUTS = tuple(f.name for f in fields(Sources))


@dataclass(frozen=True)
class Lookups:
    """Derived product-alias tables: lookup, bridge and display metadata, and the lookup's groups of
    each product, one row each, which are derived where they are not given."""

    lookup: DataFrame
    bridge: DataFrame
    metadata: DataFrame
    groups: DataFrame | None = None

    @classmethod
    def from_folder(cls, spark: SparkSession, root: str) -> Lookups:
        """The version that was written completely last."""
        return cls(*Versions(spark, root).read("lookup", "bridge", "metadata", "groups"))

    @classmethod
    def from_tables(cls, spark: SparkSession, names: Mapping[str, str]) -> Lookups:
        """Catalog tables, given as field -> table name; ``groups`` may be missing."""
        return cls(
            spark.table(names["lookup"]).select(*LOOKUP),
            spark.table(names["bridge"]).select(*BRIDGE),
            spark.table(names["metadata"]).select(*METADATA),
            spark.table(names["groups"]).select(*GROUPS) if "groups" in names else None,
        )

    def only(self, entities) -> Lookups:
        """Restrict all of them to the given markets; prunes partitions of written tables."""
        return Lookups(*(
            by_entities(df, entities)
            for df in (self.lookup, self.bridge, self.metadata, self.product_groups())
        ))

    def product_groups(self) -> DataFrame:
        return product_groups(self.lookup) if self.groups is None else self.groups


def write_lookups(lookups: Lookups, root: str, keep: int = 2) -> None:
    """Replace the tables under ``root``, partitioned by market, in one step; see ``Versions``."""
    with Versions(lookups.lookup.sparkSession, root).writing(keep) as new:
        lookup = new.put("lookup", lookups.lookup, [ENTITY])
        new.put("bridge", lookups.bridge, [ENTITY])
        new.put("metadata", lookups.metadata, [ENTITY])
        # From what is written, so that the catalog is not joined again.
        new.put("groups", product_groups(lookup), [ENTITY])


def write_result(result: DataFrame, root: str, by: tuple[str, ...] = (ENTITY,), keep: int = 2) -> None:
    """Replace the stored gap result in one step, partitioned by market, or by preset with
    ``by=("platform",)``; see ``Versions``. Its own inputs may be an older version."""
    with Versions(result.sparkSession, root).writing(keep) as new:
        new.put("result", result, list(by))


def read_result(spark: SparkSession, root: str) -> DataFrame:
    """The gap result that was written completely last. Filters on its partitions skip the others."""
    return Versions(spark, root).read("result")[0]
