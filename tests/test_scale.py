"""Plan shapes that must hold for large inputs, and results under hot keys."""

import contextlib
import io
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import standin
from shelfwise import build_lookups, lazy, refresh_lookups, sku_gap, sources, table_stage
from shelfwise.operators import alias, assortment, demand, gaps
from tests import micro
from tests.micro import buyable, order, plain_products, vendor
from tests.test_gap_brute import LOOSE, random_tables, spark_rows


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def src(spark):
    return micro.sources(spark, **random_tables(7))


def test_fact_scans_push_filters_and_prune_nested_fields(spark, src, tmp_path):
    wide = src.orders.withColumn("items", F.transform("items", lambda i: i.withField(
        "note", F.lit("long text")).withField("value_euro.discount", F.lit(1.0))))
    wide.withColumn("comment", F.lit("text")).write.parquet(f"{tmp_path}/orders")
    stored = replace(src, orders=spark.read.parquet(f"{tmp_path}/orders"))
    text = plan(sources.order_items(
        stored, micro.PERIOD.orders_from, micro.PERIOD.orders_to, ["GV_ES"]
    ))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "GreaterThanOrEqual(order_created_date_lt" in pushed
    assert re.search(r"(In|EqualTo)\(global_entity_id", pushed)
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "quantity_sold" in schema and "total_amt_paid_eur" in schema
    for unused in ("note", "discount", "comment", "vertical_type"):
        assert unused not in schema


def test_both_facts_share_one_shuffle_after_partial_sums(src):
    rates = sources.active_window_rates(src, micro.PERIOD.active_from, micro.PERIOD.active_to)
    items = sources.order_items(src, micro.PERIOD.orders_from, micro.PERIOD.orders_to)
    text = plan(assortment.sku_activity(rates, items)).split("\n\n")[0]
    assert text.count("Exchange") == 1
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")


def test_whole_job_has_no_cross_join_and_no_python(shuffled, src):
    text = plan(sku_gap(src, LOOSE, build_lookups(src), stage=lazy))
    for bad in ("Cartesian", "NestedLoop", "EvalPython", "MapInPandas", "Existing RDD"):
        assert bad not in text
    assert "LeftAnti" in text and "WindowGroupLimit" in text


@pytest.fixture
def raw_tables(spark, tmp_path):
    """Star-schema tables of 100 parts, 40 vendors and 1,000 lines of one month."""
    n = F.col("id")
    tables = {
        "part": spark.range(100).select(
            n.alias("p_partkey"), F.concat(F.lit("n"), n % 5).alias("p_name"),
            F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"),
            F.lit(1).alias("p_size")),
        "supplier": spark.range(40).select(
            n.alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(1.0).alias("s_acctbal")),
        "orders": spark.range(500).select(
            n.alias("o_orderkey"), F.lit("1997-03-05").cast("timestamp").alias("o_orderdate"),
            F.lit("F").alias("o_orderstatus")),
        "lineitem": spark.range(1000).select(
            (n % 500).alias("l_orderkey"), (n % 100).alias("l_partkey"), (n % 40).alias("l_suppkey"),
            F.lit(2.0).alias("l_quantity"), F.lit(10.0).alias("l_extendedprice"),
            F.lit(0.1).alias("l_discount"), F.lit("R").alias("l_returnflag"),
            F.lit("1997-03-05").cast("timestamp").alias("l_shipdate")),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_stand_in_files_grow_with_the_input(spark, raw_tables, monkeypatch):
    monkeypatch.setattr(standin, "FILE_ROWS", 50)
    s = standin.StandIn(spark, raw_tables)
    assert s.catalog.count() == 100 * 2 * 6
    assert s.demand_alias.count() == 45 * 6  # masters 4, 26, 48, 70 and 92 are unlisted
    cores = spark.sparkContext.defaultParallelism
    for table in (s.catalog, s.buyable_rate, s.orders):
        assert len(table.inputFiles()) > cores
    assert s.buyable_rate.count() == s.orders.count() == 1000


def test_a_month_of_a_large_fact_is_several_tasks(spark, raw_tables, monkeypatch):
    monkeypatch.setattr(standin, "MONTH_ROWS", 100)
    s = standin.StandIn(spark, raw_tables)
    rates = sources.active_window_rates(s.by_month, standin.START, standin.END)
    assert rates.count() == 1000 and len(rates.inputFiles()) > 1
    made = {**vars(s), **vars(s.by_month)}
    assert "orders" not in made and "buyable_rate" not in vars(s)
    items = sources.order_items(s.by_month, standin.START, standin.END)
    assert items.count() == 2000 and len(s.by_month.orders.inputFiles()) > 1


def test_rank_filters_reach_the_shuffle(spark):
    df = spark.range(100).select(
        F.lit("E").alias("global_entity_id"), F.lit("s").alias("vertical_segment"),
        F.lit("c").alias("city"), F.col("id").alias("alias_product_id"),
        (F.col("id") % 30).alias("total_quantity_sold"),
    ).repartition(4)
    text = plan(demand.rank_top(df)).split("\n\n")[0]
    tree = [line for line in text.splitlines() if "Exchange" in line or "GroupLimit" in line]
    assert len(tree) >= 3 and "GroupLimit" in tree[0] and "GroupLimit" in tree[2]


def test_hot_sku_with_a_third_of_all_facts(spark):
    """Sums agree with closed forms, and only partial sums travel."""
    n = 90_000
    ids = spark.range(0, n, 1, 8)
    product = F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("p"), (F.col("id") % 1000).cast("string"))
    )
    rates = ids.select(
        F.lit("E").alias("global_entity_id"), F.lit("v").alias("platform_vendor_id"),
        product.alias("platform_product_id"),
        F.lit(0.5).alias("daily_buyable_rate_eligible_ref"),
    )
    items = ids.select(
        F.lit("E").alias("global_entity_id"), F.lit("v").alias("platform_vendor_id"),
        product.alias("platform_product_id"), F.lit(2).cast("bigint").alias("quantity_sold"),
        F.lit(0.01).alias("total_amt_paid_eur"),
    )
    got = assortment.sku_activity(rates, items)
    hot = got.where("platform_product_id = 'hot'").first()
    assert (hot.items_sold, hot.quantity_sold, hot.revenue_eur) == (n // 3, 2 * n // 3, 300.0)
    assert got.agg(F.sum("items_sold")).first()[0] == n


def test_hot_vendor_is_split_when_not_broadcast(shuffled):
    spark = shuffled
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 120_000, 1, 8)
        vendor_id = F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("v"), (F.col("id") % 200).cast("string"))
        )
        groups = rows.select(
            F.lit("E").alias("global_entity_id"), vendor_id.alias("platform_vendor_id"),
            F.col("id").alias("alias_product_id"),
        )
        faces = groups.select("global_entity_id", "platform_vendor_id").distinct().select(
            "*", F.lit("s").alias("vertical_segment"), F.lit("c").alias("city"),
            F.lit("v").alias("vendor_name"), F.crc32("platform_vendor_id").alias("chain_id"),
        )
        path = f"{spark.conf.get('spark.checkpoint.dir', '/tmp')}/hot-faces"
        faces.write.mode("overwrite").parquet(path)
        frame = demand.carrying_chains(groups, spark.read.parquet(path))
        assert frame.count() == 120_000
        frame = demand.carrying_chains(groups, spark.read.parquet(path))
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().toString()
    finally:
        for key in small:
            spark.conf.unset(key)


def test_product_that_all_vendors_sell_is_split(shuffled, tmp_path):
    """The only join by product, with its groups as they are stored and as they are derived."""
    spark = shuffled
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        entity = F.lit("E").alias("global_entity_id")
        product = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 200)
        spark.range(0, 120_000, 1, 8).select(
            entity, F.col("id").alias("platform_vendor_id"), product.alias("platform_product_id"),
            F.lit(1).cast("long").alias("items_sold"), F.col("id").alias("quantity_sold"),
            F.lit(0.5).cast("decimal(38,15)").alias("revenue_eur"),
        ).write.parquet(f"{tmp_path}/activity")
        lookup = spark.range(-1, 200).select(
            entity, F.col("id").alias("platform_product_id"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("demand_alias_id"),
            F.lit(7).alias("supply_alias_id"))
        alias.product_groups(lookup).write.parquet(f"{tmp_path}/groups")
        activity = spark.read.parquet(f"{tmp_path}/activity")
        for groups in (spark.read.parquet(f"{tmp_path}/groups"), alias.product_groups(lookup)):
            frame = assortment.vendor_groups(assortment.in_groups(activity, groups))
            found = frame.collect()
            assert len(found) == 3 * 120_000
            assert sum(r.quantity_sold for r in found) == 3 * sum(range(120_000))
            assert "skew=true" in frame._jdf.queryExecution().toString()
    finally:
        for key in small:
            spark.conf.unset(key)


def test_job_deals_activity_out_by_product_once(spark, shuffled, src, tmp_path):
    """What is shuffled by product, in all plans of the job, besides the facts' own sums: activity
    and the groups, once each."""
    plans, store = [], table_stage(spark, str(tmp_path))

    def stage(name, df, by=()):
        plans.append(plan(df))
        return store(name, df, by)

    stored = refresh_lookups(spark, src, f"{tmp_path}/lookups")
    plans.append(plan(sku_gap(src, LOOSE, stored, stage)))
    dealt = [
        keys for text in plans for keys in re.findall(r"hashpartitioning\((.*?)\), ENSURE", text)
        if "platform_product_id" in keys and "platform_vendor_id" not in keys
    ]
    assert len(dealt) == 2


@pytest.mark.parametrize("unit", ["day", "month"])
def test_dated_facts_are_pruned_by_partition(spark, src, tmp_path, unit):
    """Tables partitioned by the date, and by its month."""
    facts = {"orders": "order_created_date_lt", "buyable_rate": "date_ref"}
    for name, column in facts.items():
        part = column if unit == "day" else f"{column}_month"
        rows = getattr(src, name).withColumn(part, F.trunc(column, unit) if unit == "month" else F.col(column))
        rows.write.partitionBy(part).parquet(f"{tmp_path}/{name}")
    dated = replace(src, **{n: spark.read.parquet(f"{tmp_path}/{n}") for n in facts})
    window = (micro.DAY, micro.DAY)
    first = micro.DAY if unit == "day" else micro.MONTH
    for scan, column in ((sources.order_items, "order_created_date_lt"),
                         (sources.active_window_rates, "date_ref")):
        part = column if unit == "day" else f"{column}_month"
        text = plan(scan(dated, *window))
        filters = re.search(r"PartitionFilters: (.*)", text).group(1)
        assert f"({part}" in filters and ">=" in filters and "<=" in filters
        ours, plain = scan(dated, *window), scan(src, *window)
        assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))
        assert len(list(tmp_path.glob(f"*/{part}=*"))) > 1
        read = [r[0] for r in ours.select(F.input_file_name()).distinct().collect()]
        assert read and all(f"{part}={first}" in f for f in read)
    assert spark_rows(sku_gap(dated, LOOSE)) == spark_rows(sku_gap(src, LOOSE))


def test_hot_supply_group_does_not_multiply(spark):
    """One supply group merges 20,000 demand groups and is sold by 500 chains: 10 million pairs."""
    n, chains = 20_000, 500
    cell = [F.lit("E").alias("global_entity_id"), F.lit("s").alias("vertical_segment"),
            F.lit("c").alias("city")]
    products = spark.range(n).select(
        *cell, F.col("id").alias("alias_product_id"), (F.col("id") * 2).alias("total_quantity_sold")
    )
    bridge = spark.range(n).select(
        cell[0], F.col("id").alias("demand_alias_id"), F.lit(-1).cast("bigint")
        .alias("supply_alias_id"),
    )
    who = spark.range(chains).select(
        *cell, F.col("id").alias("platform_vendor_id"), F.col("id").alias("chain_id")
    )  # chains 0 to 499
    groups = who.select("global_entity_id", "platform_vendor_id",
                        F.lit(-1).cast("bigint").alias("alias_product_id"))
    # Every product has a small group of its own besides the hot one, sold by two more chains.
    bridge = bridge.unionByName(spark.range(n).select(
        cell[0], F.col("id").alias("demand_alias_id"), F.col("id").alias("supply_alias_id")))
    who = who.withColumn("vendor_name", F.lit("v")).unionByName(spark.range(2).select(
        *cell, (F.col("id") + 1000).alias("platform_vendor_id"),
        (F.col("id") + 499).alias("chain_id"), F.lit("v").alias("vendor_name")))
    groups = groups.unionByName(
        spark.range(n).select(cell[0], F.explode(F.expr("array(1000L, 1001L)"))
                              .alias("platform_vendor_id"), F.col("id").alias("alias_product_id")))
    carrying = demand.carrying_chains(groups, who)
    assert carrying.count() == chains + 2 * n
    pairs = demand.carried_products(products, bridge, carrying)
    assert pairs.count() == 2 * n  # not n * chains
    counted = demand.chain_counts(pairs, carrying)
    assert counted.groupBy("num_chains").count().collect() == [(chains + 1, n)]
    top = demand.rank_top(demand.in_chains(counted, 3), 10)
    wanted = demand.bridged(top.select(*demand.GROUP), bridge)
    held = gaps.holders(groups, who, wanted)
    assert held.count() == 10 * (chains + 2)


def test_hot_vendor_and_hot_product_in_the_whole_job(spark):
    """A vendor with a third of all products, and a product that every vendor sells."""
    shops = [f"v{i:02d}" for i in range(40)]
    products = [f"p{i}" for i in range(1, 61)]
    stock = [(v, "p1") for v in shops] + [("v00", p) for p in products[1:]]
    stock += [("v01", p) for p in products[1:6]]
    src = micro.sources(
        spark, **plain_products(60),
        vendor_month=[vendor(v, chain=str(i % 5)) for i, v in enumerate(shops)],
        buyable_rate=[buyable(v, p) for v, p in stock for _ in range(3)],
        orders=[order(v, (p, 5, 150.0)) for v, p in stock] * 2,
        vendor_users=[micro.user(f"u{v}", v) for v in shops],
        comms_attributes=[micro.attribute(f"u{v}") for v in shops],
    )
    got = {r.platform_vendor_id: r for r in sku_gap(src, micro.PARAMS).collect()}
    # p1 sells best but nobody lacks it; p2..p6 are sold by two chains, the rest by one.
    assert set(got) == set(shops) - {"v00", "v01"}
    for r in got.values():
        assert [r[f"gap{n}_alias_product_id"] for n in (1, 2, 3)] == ["p2", "p3", "p4"]
        assert [r[f"gap{n}_market_rank"] for n in (1, 2, 3)] == [2, 2, 2]


def test_stored_lookups_are_pruned_by_market(spark, src, tmp_path):
    from shelfwise import Lookups, refresh_lookups

    stored = refresh_lookups(spark, src, str(tmp_path))
    built = build_lookups(src)
    derived = replace(built, groups=built.product_groups())
    for name in ("lookup", "bridge", "metadata", "groups"):
        ours, fresh = getattr(stored, name), getattr(derived, name)
        assert ours.columns == fresh.columns
        assert sorted(map(str, ours.collect())) == sorted(map(str, fresh.collect()))
    one = Lookups.from_folder(spark, str(tmp_path)).only(["PY_AR"])
    assert "PartitionFilters: [isnotnull(global_entity_id" in plan(one.bridge)
    refresh_lookups(spark, src, str(tmp_path))  # replaces what is there
    assert Lookups.from_folder(spark, str(tmp_path)).lookup.count() == built.lookup.count()


def test_a_refresh_that_fails_leaves_the_old_tables(spark, src, tmp_path):
    from shelfwise import Lookups, refresh_lookups, write_lookups

    refresh_lookups(spark, src, str(tmp_path))
    old = sorted(map(str, Lookups.from_folder(spark, str(tmp_path)).metadata.collect()))
    built = build_lookups(src)
    broken = built.metadata.withColumn("barcode", F.raise_error(F.lit("no")).cast("string"))
    broken = broken.withColumn("primary_barcode", F.col("barcode")).drop("barcode")
    half = Lookups(built.lookup.limit(1), built.bridge.limit(1), broken)
    with pytest.raises(Exception, match="no"):
        write_lookups(half, str(tmp_path))
    assert len(list(tmp_path.glob("version-*"))) == 1  # what was half written is gone
    tables = Lookups.from_folder(spark, str(tmp_path))
    assert sorted(map(str, tables.metadata.collect())) == old
    assert tables.lookup.count() == built.lookup.count()


def test_alias_tables_meet_once(spark, src):
    """With a stage, one join of the alias tables feeds the lookup and the bridge."""
    made = []

    def stage(name, df, by=()):
        made.append(name)
        rows = df.collect()
        return spark.createDataFrame(rows, df.schema)

    built = build_lookups(src, stage=stage)
    assert made == ["alias_pairs"]
    assert "FullOuter" not in plan(built.bridge) + plan(built.lookup)


def test_stage_tables_go_to_the_shared_folder(spark, tmp_path):
    from shelfwise.session import stage_root, table_stage

    settings = {"spark.master": "spark://host:7077", "spark.checkpoint.dir": "hdfs:///shared"}

    class Session:
        class conf:  # noqa: N801
            get = staticmethod(settings.get)

    assert stage_root(Session) == "hdfs:///shared"
    del settings["spark.checkpoint.dir"]
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        settings["spark.master"] = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            stage_root(Session)
    settings["spark.master"] = "local[8]"
    assert stage_root(Session) == stage_root(Session)
    staged = table_stage(spark, str(tmp_path))("numbers", spark.range(5))
    assert staged.count() == 5 and list(tmp_path.glob("run-*/numbers/*.parquet"))
