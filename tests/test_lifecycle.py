"""Stored results, versions and stage folders over several runs."""

import pytest
from pyspark.sql import functions as F

from shelfwise import (
    Lookups, Sources, build_lookups, read_result, refresh_lookups, run_stages, sku_gap, sku_gap_platforms,
    write_result,
)
from shelfwise.operators import targeting
from shelfwise.sources import INPUTS, Versions
from tests import micro
from tests.test_gap_brute import LOOSE, random_tables, spark_rows
from tests.test_scale import plan


@pytest.fixture(scope="module")
def src(spark):
    return micro.sources(spark, **random_tables(7))


@pytest.fixture(scope="module")
def result(spark, src, tmp_path_factory):
    """One gap result, stored plainly."""
    path = str(tmp_path_factory.mktemp("gap") / "result")
    sku_gap(src, LOOSE).write.parquet(path)
    return spark.read.parquet(path)


def same(a, b):
    return a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_result_is_partitioned_by_market(spark, result, tmp_path):
    write_result(result, str(tmp_path))
    stored = read_result(spark, str(tmp_path))
    assert same(stored, result) and stored.schema.simpleString() == result.schema.simpleString()
    one = stored.where("global_entity_id = 'PY_AR'")
    assert "PartitionFilters: [isnotnull(global_entity_id" in plan(one)
    files = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert files and all("global_entity_id=PY_AR" in f for f in files)
    assert same(one, result.where("global_entity_id = 'PY_AR'"))


def test_a_write_that_fails_keeps_the_old_result(spark, result, tmp_path):
    write_result(result, str(tmp_path))
    late = F.when(F.col("platform_vendor_id") == "v3", F.raise_error(F.lit("disk full")))
    broken = result.withColumn("vendor_name", F.coalesce(late.cast("string"), "vendor_name"))
    with pytest.raises(Exception, match="disk full"):
        write_result(broken, str(tmp_path))
    assert same(read_result(spark, str(tmp_path)), result)
    assert len(list(tmp_path.glob("version-*"))) == 1


def test_a_result_may_replace_what_it_was_read_from(spark, result, tmp_path):
    write_result(result, str(tmp_path))
    half = read_result(spark, str(tmp_path)).where("global_entity_id = 'GV_ES'")
    write_result(half, str(tmp_path))
    assert same(read_result(spark, str(tmp_path)), result.where("global_entity_id = 'GV_ES'"))


def test_an_empty_result_can_be_read(spark, result, tmp_path):
    write_result(result.limit(0), str(tmp_path))
    stored = read_result(spark, str(tmp_path))
    assert stored.columns == result.columns and stored.count() == 0


def test_readers_of_the_old_version_go_on(spark, result, tmp_path):
    root = str(tmp_path)
    write_result(result, root)
    old = read_result(spark, root)
    write_result(result.limit(1), root)
    assert same(old, result)  # files of the version it was opened at
    assert read_result(spark, root).count() == 1
    write_result(result.limit(2), root)
    assert len(list(tmp_path.glob("version-*"))) == 2  # the first one is gone
    write_result(result.limit(3), root, keep=1)
    assert len(list(tmp_path.glob("version-*"))) == 1
    assert read_result(spark, root).count() == 3
    with pytest.raises(ValueError, match="keep"):
        write_result(result, root, keep=0)
    assert read_result(spark, root).count() == 3


def test_refresh_keeps_as_many_versions_as_told(spark, src, tmp_path):
    root = str(tmp_path)
    first = refresh_lookups(spark, src, root)
    fresh = first.lookup.count()
    refresh_lookups(spark, src, root)
    assert spark_rows(sku_gap(src, LOOSE, first)) == spark_rows(sku_gap(src, LOOSE))
    refresh_lookups(spark, src, root, keep=3)
    assert len(list(tmp_path.glob("version-*"))) == 3 and first.lookup.count() == fresh
    refresh_lookups(spark, src, root, keep=1)
    assert len(list(tmp_path.glob("version-*"))) == 1
    assert Lookups.from_folder(spark, root).lookup.count() == fresh


def test_tables_of_one_version_belong_together(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    for n in (3, 5):
        with versions.writing() as new:
            for name in ("a", "b"):
                new.put(name, spark.range(n).withColumn("part", F.col("id") % 2), ["part"])
    assert [df.count() for df in versions.read("a", "b")] == [5, 5]
    assert versions.read("a")[0].columns == ["id", "part"]


def test_nothing_published(spark, tmp_path):
    with Versions(spark, str(tmp_path)).writing() as new:
        new.put("other", spark.range(1).withColumn("p", F.lit(1)), ["p"])
    with pytest.raises(KeyError):
        read_result(spark, str(tmp_path))


def test_stage_folders_go_after_the_run(spark, src, tmp_path):
    root = tmp_path / "stages"
    with run_stages(spark, str(root)) as stage:
        write_result(sku_gap(src, LOOSE, stage=stage), f"{tmp_path}/gaps")
        assert len(list(root.glob("run-*/*"))) >= 5
    assert not list(root.glob("run-*"))
    assert spark_rows(read_result(spark, f"{tmp_path}/gaps")) == spark_rows(sku_gap(src, LOOSE))
    with pytest.raises(RuntimeError), run_stages(spark, str(root)) as stage:
        stage("numbers", spark.range(3))
        raise RuntimeError
    assert not list(root.glob("run-*"))


def test_order_is_a_column(spark, src, result, tmp_path):
    with run_stages(spark, str(tmp_path)) as stage:
        placed = targeting.in_order(result, stage)
        found = placed.collect()
        assert sorted(map(str, placed.drop("position").collect())) == sorted(map(str, result.collect()))
    assert sorted(r.position for r in found) == list(range(1, len(found) + 1))
    found.sort(key=lambda r: r.position)
    keys = [(*r[:3], r.platform_vendor_id, r.vendor_name, r.uuid) for r in found]
    assert len(keys) >= 10 and keys == sorted(keys)
    ordered = sku_gap(src, LOOSE, ordered=True)
    assert ordered.columns[-1] == "position" and ordered.count() == len(found)
    assert "position" not in sku_gap(src, LOOSE).columns


def test_one_preset_is_read_without_the_others(spark, src, tmp_path):
    loose = {k: getattr(LOOSE, k) for k in ("min_avg_revenue", "min_avg_qty", "top_products")}
    made = sku_gap_platforms(src, micro.PERIOD, **loose)
    write_result(made, str(tmp_path), by=("platform",))
    stored = read_result(spark, str(tmp_path))
    assert same(stored, made) and {r[0] for r in stored.select("platform").collect()} == {"gv", "py"}
    for preset in ("gv", "py", "tb"):
        one = stored.where(F.col("platform") == preset)
        files = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
        assert all(f"platform={preset}" in f for f in files)
        params = LOOSE.preset(preset, micro.PERIOD, **loose)
        assert spark_rows(one) == spark_rows(sku_gap(src, params))


def test_inputs_and_lookups_by_table_name(spark, src):
    """As a warehouse names them."""
    spark.sql("CREATE DATABASE IF NOT EXISTS gap_inputs")
    try:
        for name in INPUTS:
            getattr(src, name).write.mode("overwrite").saveAsTable(f"gap_inputs.{name}")
        named = Sources.from_tables(spark, {n: f"gap_inputs.{n}" for n in INPUTS})
        built = build_lookups(named)
        for name in ("lookup", "bridge", "metadata"):
            getattr(built, name).write.mode("overwrite").saveAsTable(f"gap_inputs.stored_{name}")
        tables = {n: f"gap_inputs.stored_{n}" for n in ("lookup", "bridge", "metadata")}
        want = spark_rows(sku_gap(src, LOOSE))
        assert want and spark_rows(sku_gap(named, LOOSE, Lookups.from_tables(spark, tables))) == want
        built.product_groups().write.mode("overwrite").saveAsTable("gap_inputs.stored_groups")
        tables["groups"] = "gap_inputs.stored_groups"
        assert spark_rows(sku_gap(named, LOOSE, Lookups.from_tables(spark, tables))) == want
    finally:
        spark.sql("DROP DATABASE gap_inputs CASCADE")
