from __future__ import annotations

import uuid
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators import quality
from martflow.plans import run
from martflow.sources import catalog
from martflow.sources.landing import load_landing
from martflow.sources.layers import DATA_MART, INFO_MART, LANDING, REPORTS, STAGE1, Layers
from martflow.sources.workdir import run_folder, scratch, shared_folder, store
from suite import queries, standins


@pytest.fixture()
def layers(spark):
    return Layers(run_folder(spark, "test"))


@pytest.fixture()
def database(spark, layers):
    name = f"test_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, f"{layers.root}/managed")
    return name


def test_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_folder(spark, "x") != run_folder(spark, "x")


def test_store_ends_the_lineage(spark):
    stored = store(spark.range(5).withColumn("x", F.col("id") * 2))
    assert len(stored.inputFiles()) > 0
    assert rows(stored) == [(i, 2 * i) for i in range(5)]


def test_overwrite_replaces_rows_and_schema(spark, layers):
    layers.write(spark.range(3), INFO_MART, "t")
    new = spark.range(2).select(F.col("id").cast("string").alias("name"))
    for _ in range(2):
        layers.write(new, INFO_MART, "t")
        assert rows(layers.read(spark, INFO_MART, "t")) == [("0",), ("1",)]


def test_a_dead_write_leaves_the_old_table(spark, layers):
    layers.write(spark.range(3), INFO_MART, "t")
    old = layers.read(spark, INFO_MART, "t")
    fails = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        layers.write(fails, INFO_MART, "t")
    assert rows(layers.read(spark, INFO_MART, "t")) == [(0,), (1,), (2,)]
    # written whole, but not published
    folder = layers.stage(spark.range(7), INFO_MART, "t")
    assert layers.read(spark, INFO_MART, "t").count() == 3
    layers.publish(spark, INFO_MART, "t", folder)
    assert layers.read(spark, INFO_MART, "t").count() == 7
    assert old.count() == 3  # a query on the old version can end
    # a table may be replaced by what is computed from it
    layers.write(layers.read(spark, INFO_MART, "t").filter("id > 4"), INFO_MART, "t")
    assert rows(layers.read(spark, INFO_MART, "t")) == [(5,), (6,)]


def test_old_versions_are_emptied(spark, layers):
    assert not layers.exists(spark, INFO_MART, "t") and layers.retain(spark, INFO_MART, "t") == []
    for n in range(1, 5):
        layers.write(spark.range(n), INFO_MART, "t")
    known = [folder for _, folder in layers.versions(spark, INFO_MART, "t")]
    assert len(known) == 4
    gone = layers.retain(spark, INFO_MART, "t", keep=2)
    assert gone == known[2:]
    assert [f for _, f in layers.versions(spark, INFO_MART, "t")] == known[:2]
    assert layers.staged(spark, INFO_MART, "t", gone[0]).count() == 0
    assert layers.read(spark, INFO_MART, "t").count() == 4
    assert layers.retain(spark, INFO_MART, "t", keep=0) == known[1:2]
    assert layers.read(spark, INFO_MART, "t").count() == 4
    with pytest.raises(FileNotFoundError):
        layers.read(spark, INFO_MART, "never")


def test_scratch_tables_go_at_the_end(spark):
    with scratch(spark):
        stored = store(spark.range(50))
        folder = stored.inputFiles()[0].rsplit("/", 1)[0]
        assert stored.count() == 50
    assert spark.read.parquet(folder).count() == 0
    kept = store(spark.range(5))
    assert kept.count() == 5


def test_partitioned_layer_prunes(spark, layers):
    layers.write(spark.range(10).selectExpr("id", "id % 2 AS p"), DATA_MART, "t", ["p"])
    found = layers.read(spark, DATA_MART, "t").filter("p = 1")
    assert found.count() == 5
    assert "PartitionFilters: [isnotnull(p" in found._jdf.queryExecution().toString()


def test_read_may_merge_schemas(spark, layers):
    path = layers.path(LANDING, "t")
    spark.sql("SELECT 1 AS a").write.parquet(path)
    spark.sql("SELECT 2 AS a, 3 AS b").write.mode("append").parquet(path)
    found = layers.read(spark, LANDING, "t", merge_schema=True)
    assert rows(found) == [(1, None), (2, 3)]


def test_conform(spark):
    df = spark.sql("SELECT 1 AS b")
    target = spark.sql("SELECT 'x' AS a, 2L AS b").schema
    found = catalog.conform(df, target)
    assert found.schema.simpleString() == "struct<a:string,b:bigint>"
    assert found.first() == (None, 1)
    with pytest.raises(ValueError):
        catalog.conform(spark.sql("SELECT 1 AS c"), target)


def test_publish_merges_schemas_and_may_read_itself(spark, layers, database):
    location = layers.path(DATA_MART, "t")
    catalog.publish_external(spark.sql("SELECT 1 AS a, 'x' AS b"), database, "t", location)
    found = catalog.publish_external(spark.sql("SELECT 2 AS a, 3.5D AS c"), database, "t", location)
    assert found.columns == ["a", "b", "c"]
    assert found.first() == (2, None, 3.5)
    again = catalog.publish_external(found.union(found), database, "t", location)
    assert again.count() == 2


def test_publication_widens_numbers(spark, layers, database):
    location = layers.path(DATA_MART, "w")
    kinds = []
    for text in ("1", "3000000000L", "12345678901234567890BD", "1.25BD", "7"):
        found = catalog.publish_external(spark.sql(f"SELECT {text} AS a, 'x' AS b"), database, "w", location)
        kinds.append(found.schema["a"].dataType.simpleString())
        assert str(found.first()["a"]).startswith(text.rstrip("LBD"))
        assert spark.table(f"{database}.w").schema == found.schema
    assert kinds == ["int", "bigint", "decimal(20,0)", "decimal(22,2)", "decimal(22,2)"]
    for text in ("'text'", "1.5D", "date '2020-01-01'"):
        with pytest.raises(ValueError, match="cannot hold"):
            catalog.publish_external(spark.sql(f"SELECT {text} AS a"), database, "w", location)
    assert spark.table(f"{database}.w").first()["a"] == 7


def test_merged_types():
    decimal = T.DecimalType
    assert catalog.merged_type(T.LongType(), T.IntegerType()) == T.LongType()
    assert catalog.merged_type(T.IntegerType(), decimal(12, 2)) == decimal(12, 2)
    assert catalog.merged_type(T.LongType(), decimal(12, 2)) == decimal(21, 2)
    assert catalog.merged_type(decimal(38, 0), decimal(5, 4)) is None
    assert catalog.merged_type(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert catalog.merged_type(T.LongType(), T.DoubleType()) is None
    assert catalog.merged_type(T.StringType(), T.IntegerType()) == T.StringType()
    assert catalog.merged_type(T.IntegerType(), T.StringType()) is None


def test_insert_overwrite_is_by_name(spark, database):
    table = catalog.create_managed(spark.sql("SELECT 1 AS a, 2 AS b"), database, "m")
    assert table.first() == (1, 2)
    swapped = spark.sql("SELECT 20 AS b, 10 AS a")
    assert catalog.insert_overwrite(swapped, database, "m").first() == (10, 20)


def test_registered_tables_can_be_queried(spark, layers, database):
    layers.write(spark.range(4), INFO_MART, "numbers")
    for _ in range(2):
        catalog.register_tables(spark, layers, database, ["numbers"])
    assert catalog.registered_tables(spark, database) == ["numbers"]
    assert spark.sql(f"SELECT count(*) FROM {database}.numbers").first()[0] == 4


def test_registration_follows_the_files(spark, layers, database):
    for df in (spark.range(4), spark.range(2), spark.range(3).selectExpr("id AS other")):
        layers.write(df, INFO_MART, "t")
        catalog.register_tables(spark, layers, database, ["t"])
        found = catalog.scan_table(spark, database, "t")
        assert rows(found) == rows(df)
        assert found.columns == df.columns


def test_whole_run_twice_gives_the_same(spark, sf_dir, layers, database):
    layers.write_all(standins.sources(spark, sf_dir), LANDING)
    setting = queries.the_setting(spark)
    results = []
    for profile in (True, False):
        done = run.run_all(spark, layers, setting, database, queries.THRESHOLDS, profile=profile)
        mart = done.mart
        results.append(
            mart.agg(F.count("*"), F.sum(F.xxhash64(*sorted(mart.columns)).cast("decimal(38,0)"))).first()
        )
    assert results[0] == results[1]
    assert done.dates.agg(F.sum("uncovered")).first()[0] == 0
    assert done.profile is None and layers.read(spark, REPORTS, "profile").count() > 0
    assert all(r.isEmpty() for r in done.cleansed.rejects.values())
    with pytest.raises(ValueError, match="date ids count"):
        run.run_lookups(spark, layers, replace(setting, calendar=standins.CALENDAR))
    report = run.run_key_report(spark, layers, setting)
    assert report.agg(F.sum("bad_rows")).first()[0] == 0
    assert run.run_profile(spark, layers, standins.CONTRACT).count() > 0


def test_bad_keys_are_set_aside_or_stop_the_run(spark, sf_dir, layers):
    layers.write_all(standins.sources(spark, sf_dir), LANDING)
    setting = replace(queries.the_setting(spark), contract=standins.LOOSE_CONTRACT)
    strict = replace(setting, raise_on_bad_keys=True)
    with pytest.raises(ValueError, match="primary key violations"):
        run.run_cleanse(spark, layers, strict, standins.LOOSE_TABLES)
    assert not layers.exists(spark, STAGE1, "orders")  # nothing was published
    done = run.run_cleanse(spark, layers, setting, (*standins.LOOSE_TABLES, "brands"))
    ends = {r["table_name"]: r["rows"] for r in done.steps.filter("step = 'recast'").collect()}
    for name, kept in done.tables.items():
        rejects = done.rejects[name]
        assert rejects.columns == [*kept.columns, quality.REASON]
        assert kept.count() + rejects.count() == ends[name]
    assert done.rejects["orders"].select(quality.REASON).distinct().count() == 2
    assert done.rejects["brands"].isEmpty()
    assert layers.read(spark, REPORTS, "keys").filter("bad_rows > 0").count() > 0
    with pytest.raises(ValueError):
        run.run_cleanse(spark, layers, strict, ("orders",))
    assert layers.read(spark, STAGE1, "orders").count() == done.tables["orders"].count()


def test_empty_landing_tables(spark, sf_dir, layers):
    empty = {n: df.limit(0) for n, df in standins.sources(spark, sf_dir).items()}
    layers.write_all(empty, LANDING)
    done = run.run_cleanse(spark, layers, queries.the_setting(spark))
    assert done.steps.count() == 43 and done.steps.agg(F.sum("rows")).first()[0] == 0
    assert all(df.isEmpty() for df in done.tables.values())


def test_landing_is_cast_by_contract(spark, sf_dir, layers):
    layers.write_all(standins.sources(spark, sf_dir), LANDING)
    tables = load_landing(spark, layers, standins.CONTRACT)
    assert dict(tables["orders"].dtypes)["order_id"] == "int"
    assert dict(tables["orders"].dtypes)["order_date"] == "date"
