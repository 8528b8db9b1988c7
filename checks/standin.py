"""The nine inputs, derived by Spark from the star-schema test tables.

Rules are those of FIXTURES.md, with a real market code of each preset, so that all six select something.
Each input is written once per session and then read like any stored table.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import (
    GapParams, Lookups, Period, configure, read_result, refresh_lookups, run_stages, sku_gap,
    write_result,
)
from shelfwise.columns import SKU
from shelfwise.operators import assortment
from shelfwise.session import stage_root

EVEN_MARKET, ODD_MARKET = "GV_ES", "PY_AR"
#: One market of each other preset, by vendor key modulo 24.
SMALL_MARKETS = {4: "TB_AE", 7: "HS_SA", 10: "FP_PK", 13: "EF_GR"}
REPORT_MONTH = date(1999, 12, 1)
START, END = date(1996, 1, 1), date(1999, 12, 31)
PERIOD = Period(REPORT_MONTH, START, END, START, END)
PARAMS = GapParams(period=PERIOD)
#: Vendors of November, availability of the last years, orders of one month.
#: Rows of a stand-in file.
FILE_ROWS = 250_000
#: Rows of a fact from which on each month is dealt to several tasks, one more for as many rows.
MONTH_ROWS = 10_000_000
THREE_WINDOWS = Period.rolling(date(1999, 12, 15), date(1997, 5, 1), days=2000)


def market(key: Column) -> Column:
    name = F.when(key % 2 == 0, EVEN_MARKET).otherwise(ODD_MARKET)
    for rest, small in SMALL_MARKETS.items():
        name = F.when(key % 24 == rest, small).otherwise(name)
    return name.alias("global_entity_id")


def all_markets() -> Column:
    names = (EVEN_MARKET, ODD_MARKET, *SMALL_MARKETS.values())
    return F.explode(F.array(*map(F.lit, names))).alias("global_entity_id")


class StandIn:
    """Has the attributes of ``Sources``; each is built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # as the expected SQL reads dates
        self.root = f"{stage_root(spark)}/standin-{uuid.uuid4().hex[:12]}"

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def files(self, name: str, each: int = 1) -> int:
        """Over how many files to spread ``each`` rows for every row of a raw table. A one-file source
        would be read by one task; a count that does not grow would let every task grow instead."""
        rows = self.raw(name).count() * each
        return max(self.spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))

    def stored(self, name: str, df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    @cached_property
    def vendor_count(self) -> int:
        return self.raw("supplier").count()

    @cached_property
    def catalog(self) -> DataFrame:
        """Every part under its own master product and, older, under the next one."""
        p = F.col("p_partkey")
        master = p - p % 2
        listed = F.timestamp_seconds(F.lit(631_152_000))  # 1990-01-01

        def row(master_id, created, products):
            return F.struct(
                master_id.alias("catalog_master_product_id"),
                created.alias("master_product_created_at_utc"),
                products.alias("vendor_products"),
            )

        product = F.struct(p.alias("platform_product_id"))
        unknown = F.struct(F.lit(None).cast("bigint").alias("platform_product_id"))
        created = F.timestamp_seconds(788_918_400 + F.col("p_size") * 86_400 + p)  # from 1995-01-01
        own = row(master, created, F.array(product, unknown))
        stray = row(master + 2, F.when(p % 3 != 0, listed), F.array(product))
        parts = self.raw("part").repartition(self.files("part", 12), p)  # two rows in six markets
        rows = parts.select(F.explode(F.array(own, stray)).alias("r"))
        return self.stored("catalog", rows.select(all_markets(), "r.*"))

    def _alias(self, keys: list[str], unlisted: str) -> DataFrame:
        """Each table misses some master products, so some have only one alias, and some none."""
        masters = self.raw("part").where("p_partkey % 2 = 0").where(f"NOT ({unlisted})")
        groups = masters.groupBy(*keys).agg(F.min("p_partkey").alias("alias_product_id"))
        spread = masters.repartition(self.files("part", 6), "p_partkey")
        return spread.join(groups, keys).withColumn(
            "catalog_master_product_id", F.col("p_partkey")
        )

    @cached_property
    def demand_alias(self) -> DataFrame:
        master = F.col("catalog_master_product_id")
        rows = self._alias(["p_name", "p_brand", "p_type"], "p_partkey % 22 = 4").select(
            all_markets(),
            "catalog_master_product_id",
            "alias_product_id",
            F.concat_ws(" ", "p_name", "p_brand").alias("catalog_master_product_name_alias"),
            F.when(master % 3 != 0, F.col("p_name")).alias("primary_name_local"),
            F.concat_ws(" ", "p_type", "p_name").alias("primary_name_english"),
            F.lpad(master.cast("string"), 13, "0").alias("primary_barcode"),
            F.concat(F.lit("/img/"), master.cast("string")).alias("primary_image_url"),
        )
        return self.stored("demand_alias", rows)

    @cached_property
    def supply_alias(self) -> DataFrame:
        rows = self._alias(["p_name", "p_brand"], "p_partkey % 26 = 6").select(
            all_markets(), "catalog_master_product_id", "alias_product_id"
        )
        return self.stored("supply_alias", rows)

    @cached_property
    def vendor_month(self) -> DataFrame:
        """The report month, and the month before it with other figures."""
        k = F.col("s_suppkey")
        chain = F.when(k % 7 != 0, k % 7)
        sessions = F.when(k % 11 != 0, (k * 7919) % 900 + 100)
        gmv = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") * 100)
        month = F.explode(F.array(F.lit(REPORT_MONTH), F.lit(date(1999, 11, 1))))
        rows = self.raw("supplier").select("*", month.alias("report_month"))
        current = F.col("report_month") == F.lit(REPORT_MONTH)
        return self.stored("vendor_month", rows.select(
            market(k),
            "report_month",
            k.alias("platform_vendor_id"),
            F.col("s_name").alias("vendor_name"),
            chain.alias("chain_id"),
            F.concat(F.lit("Chain "), chain.cast("string")).alias("chain_name"),
            F.when(k % 9 == 8, "Dark Store").otherwise("Shop").alias("vertical"),
            F.when(k % 4 == 3, "kiosk").otherwise("grocery").alias("vertical_segment"),
            F.concat(F.lit("C"), (F.floor(k / 2) % 2).cast("string")).alias("city"),
            F.when(k % 13 == 12, True).when(k % 13 != 5, False).alias("is_key_partner"),
            (k % 17 != 16).alias("is_online"),
            F.when(current, sessions).otherwise(sessions * 2).alias("menu_sessions"),
            F.when(current, gmv).otherwise(F.lit(1.0)).alias("gmv_eur"),
            ((k * 31) % 101).cast("double").alias("vps_v11"),
        ))

    def _rates(self) -> DataFrame:
        rate = F.when(F.col("l_returnflag") == "R", 1 - F.col("l_discount")).otherwise(0.0)
        return self.raw("lineitem").select(
            market(F.col("l_suppkey")),
            F.col("l_suppkey").alias("platform_vendor_id"),
            F.col("l_partkey").alias("platform_product_id"),
            F.col("l_shipdate").cast("date").alias("date_ref"),
            rate.alias("daily_buyable_rate_eligible_ref"),
        )

    @cached_property
    def buyable_rate(self) -> DataFrame:
        return self.stored(
            "buyable_rate", self._rates().repartition(self.files("lineitem"), *SKU, "date_ref")
        )

    def _lines(self) -> DataFrame:
        """Order lines with their order, spread by it: the one exchange of the join."""
        n = self.files("lineitem")
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"
        ).repartition(n, "l_orderkey")
        orders = self.raw("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
        return lines.join(
            orders.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.stored("orders", self._orders(self._lines()))

    def _orders(self, lines: DataFrame) -> DataFrame:
        """One order per line; a quantity above 1 is split into a paid and an unpriced item."""
        qty = F.col("l_quantity").cast("bigint")
        half = F.floor(qty / 2)
        paid = F.col("l_extendedprice") * (1 - F.col("l_discount"))

        def item(quantity, amount):
            return F.struct(
                F.col("l_partkey").alias("platform_product_id"),
                quantity.alias("quantity_sold"),
                F.struct(amount.alias("total_amt_paid_eur")).alias("value_euro"),
            )

        items = F.when(
            half > 0, F.array(item(qty - half, paid), item(half, F.lit(None).cast("double")))
        ).otherwise(F.array(item(qty, paid)))
        key = F.col("l_orderkey")
        return lines.select(
            market(F.col("l_suppkey")),
            F.col("l_suppkey").alias("platform_vendor_id"),
            F.col("o_orderdate").cast("date").alias("order_created_date_lt"),
            (F.col("o_orderstatus") != "P").alias("is_successful"),
            F.when(key % 10 == 0, "darkstores").when(key % 10 != 1, "shop").alias("vertical_type"),
            items.alias("items"),
        )

    @cached_property
    def vendor_users(self) -> DataFrame:
        """One vendor per user, two for every fifth, none for every 29th."""
        k = F.col("c_custkey")

        def node(vendor):
            return F.struct(
                vendor.alias("vendor_id"),
                market(vendor),
                F.when(k % 19 == 0, True).when(k % 3 != 0, False).alias("node_is_deleted"),
            )

        first, second = node(k % self.vendor_count), node((k + 1) % self.vendor_count)
        nodes = (
            F.when(k % 58 == 0, F.lit(None))
            .when(k % 29 == 0, F.slice(F.array(first), 1, 0))
            .when(k % 5 == 0, F.array(first, second))
            .otherwise(F.array(first))
        )
        return self.stored("vendor_users", self.raw("customer").select(
            F.concat(F.lit("U"), k.cast("string")).alias("user_id"),
            (k % 23 == 0).alias("is_deleted"),
            nodes.alias("vendors"),
        ))

    @cached_property
    def comms_attributes(self) -> DataFrame:
        k, segment = F.col("c_custkey"), F.col("c_mktsegment")
        return self.stored("comms_attributes", self.raw("customer").select(
            F.concat(F.lit("U"), k.cast("string")).alias("uuid"),
            F.when(segment != "HOUSEHOLD", segment).alias("va_vertical_food"),
            F.when(k % 2 == 0, "owner").otherwise("staff").alias("cd_role"),
            (k % 5 == 0).alias("cd_is_multi_vendor_user"),
        ))

    @cached_property
    def sku_threshold(self) -> DataFrame:
        """Grocery only: kiosks have no threshold on purpose."""
        in_window = self.buyable_rate.where(F.col("date_ref").between(F.lit(START), F.lit(END)))
        active = in_window.groupBy(*SKU).agg(
            F.sum("daily_buyable_rate_eligible_ref").alias("rate")).where("rate > 0")
        return self.stored("sku_threshold", assortment.vendor_sku_count(active).groupBy("global_entity_id").agg(
            (F.max("vendor_active_skus") + 0.75).alias("mature_threshold")
        ).select(
            "global_entity_id", F.lit("grocery").alias("vertical_segment"), "mature_threshold"
        ))

    @cached_property
    def by_month(self) -> ByMonth:
        return ByMonth(self)

    def dealt_by_month(self, rows: DataFrame, day: Column, *spread: str) -> DataFrame:
        """Rows of a fact dealt out by month. A month of a large fact is cut in several, by the columns
        ``spread``, as the sort that writes its folders holds what one task was dealt."""
        pieces = self.raw("lineitem").count() // MONTH_ROWS + 1
        piece = F.pmod(F.xxhash64(*spread), F.lit(pieces))
        return rows.repartition(self.files("lineitem"), F.trunc(day.cast("date"), "month"), piece)

    @cached_property
    def lookups(self) -> Lookups:
        """The stored alias tables."""
        return refresh_lookups(self.spark, self, f"{self.root}/lookups")


    @cached_property
    def gap_result(self) -> DataFrame:
        """The stored result of the gap job over all markets, which the reports read."""
        path = f"{self.root}/gap_result"
        with run_stages(self.spark) as stage:
            write_result(sku_gap(self, PARAMS, self.lookups, stage), path)
        return read_result(self.spark, path)


class ByMonth:
    """The facts of a stand-in partitioned by month, each made when it is first read, from the raw
    tables: a query over one of them makes neither the other nor the fact in its first layout."""

    def __init__(self, s: StandIn):
        self.s = s

    def _stored(self, name: str, rows: DataFrame, day: str) -> DataFrame:
        month = f"{day}_month"
        return self.s.stored(
            f"{name}_by_month", rows.withColumn(month, F.trunc(day, "month")), (month,)
        )

    @cached_property
    def buyable_rate(self) -> DataFrame:
        rows = self.s.dealt_by_month(
            self.s._rates(), F.col("date_ref"), "platform_vendor_id", "platform_product_id"
        )
        return self._stored("buyable_rate", rows, "date_ref")

    @cached_property
    def orders(self) -> DataFrame:
        # Dealt before the items are nested, which are several times as large.
        lines = self.s.dealt_by_month(self.s._lines(), F.col("o_orderdate"), "l_orderkey")
        return self._stored("orders", self.s._orders(lines), "order_created_date_lt")


_OPEN: dict[tuple[str, str], StandIn] = {}


def standin(spark: SparkSession, sf_dir: str) -> StandIn:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = StandIn(spark, sf_dir)
    return _OPEN[key]
