from __future__ import annotations

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from martflow.operators.joins import (
    HOT_CELLS,
    MAX_HOT_KEYS,
    Skew,
    count_keys,
    expand_join,
    find_hot_keys,
    hot_keys,
    lookup_join,
)

SPREAD = Skew(min_bytes=0, min_hot_rows=50, salts=8)


@pytest.fixture()
def lines(spark):
    """300 lines: a third on order 7, some without an order, some on unknown orders."""
    return spark.range(300).select(
        F.when(F.col("id") < 100, 7)
        .when(F.col("id") < 120, None)
        .otherwise(F.col("id") % 40)
        .alias("order_id"),
        F.col("id").alias("line"),
    )


@pytest.fixture()
def orders(spark):
    """Orders 0..29 and 100..109, the latter without lines, and one without a key."""
    keyed = spark.range(30).union(spark.range(100, 110)).select(
        F.col("id").alias("order_id"), (F.col("id") * 10).alias("customer")
    )
    return keyed.union(spark.sql("SELECT cast(NULL AS bigint), cast(-1 AS bigint)"))


def test_every_heavy_key_is_hot_and_salted_by_its_weight(spark):
    counts = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("rows"))
    found = hot_keys(counts, ["k"], Skew(min_hot_rows=1500, salts=1)).collect()
    assert len(found) == 1501  # no key is left out for there being many
    assert {r["k"]: r["__hot"] for r in found}[2999] == 2
    assert len(found) <= MAX_HOT_KEYS


def test_hot_keys_found_by_cells_are_those_of_all_counts(spark):
    """1,500 hot keys among 20,000, beside keys of NULL; with many cells and with hardly any."""
    key = F.when(F.col("id") % 7 == 0, F.col("id") % 20_000 + 10_000).otherwise(F.col("id") % 1500)
    df = spark.range(0, 300_000, 1, 6).select(F.when(F.col("id") % 97 > 0, key).alias("k"), F.lit("a").alias("part"))
    skew = Skew(min_hot_rows=100, salts=2)
    wanted = rows(hot_keys(count_keys(df.filter("k IS NOT NULL"), ["k"]), ["k"], skew))
    assert len(wanted) == 1500
    for cells in (HOT_CELLS, 64, 1):
        assert rows(find_hot_keys(df, ["k"], skew, cells)) == wanted
    assert rows(find_hot_keys(df, ["k", "part"], skew).drop("part")) == wanted
    assert find_hot_keys(df.limit(0), ["k"], skew).isEmpty()


def test_only_keys_of_hot_cells_are_counted(spark):
    """Of 100,000 keys with three rows and one with a third of all, hardly more than the latter is shuffled."""
    df = spark.range(0, 400_000, 1, 4).select(F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id") % 100_000).alias("k"))
    found = find_hot_keys(df, ["k"], Skew(min_hot_rows=50_000))
    assert [r["k"] for r in found.collect()] == [-1]
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert plan.index("hashpartitioning(k") < plan.index("LeftSemi")  # the shuffle of keys is above the filter


def test_hot_keys_are_bounded_by_their_share(spark):
    counts = spark.range(10).select(F.col("id").alias("k"), F.lit(5).alias("rows"))
    heavy = spark.createDataFrame([(100, 5 * MAX_HOT_KEYS)], "k bigint, rows int")
    found = hot_keys(counts.union(heavy), ["k"], Skew(min_hot_rows=1, salts=3)).collect()
    assert [r["k"] for r in found] == [100]


def test_hot_keys_leave_out_null(lines):
    found = hot_keys(count_keys(lines, ["order_id"]), ["order_id"], Skew(min_hot_rows=10))
    assert [r["order_id"] for r in found.collect()] == [7]


def test_spread_inner_join_is_the_inner_join(lines, orders, no_broadcast):
    expected = lines.join(orders, "order_id", "inner")
    assert rows(lookup_join(lines, orders, "order_id", skew=SPREAD, how="inner")) == rows(expected)
    assert rows(lookup_join(lines, orders, "order_id", how="inner")) == rows(expected)


def test_inner_join_keeps_partners_without_a_name(spark):
    many = spark.createDataFrame([(1,), (2,), (3,)], "store_id int")
    one = spark.createDataFrame([(1, "a"), (2, None)], "store_id int, store_name string")
    assert rows(lookup_join(many, one, "store_id", how="inner")) == [(1, "a"), (2, None)]


def test_spread_lookup_join_is_the_left_join(lines, orders, no_broadcast):
    expected = lines.join(orders, "order_id", "left")
    found = lookup_join(lines, orders, "order_id", skew=SPREAD)
    assert rows(found) == rows(expected)
    assert found.columns == expected.columns


def test_spread_expand_join_is_the_left_join(lines, orders, no_broadcast):
    expected = orders.join(lines, "order_id", "left")
    found = expand_join(orders, lines, "order_id", skew=SPREAD)
    assert rows(found) == rows(expected)
    assert found.columns == expected.columns


def test_spread_joins_with_keys_that_repeat_on_both_sides(lines, orders, no_broadcast):
    twice = orders.union(orders)
    assert rows(lookup_join(lines, twice, "order_id", skew=SPREAD)) == rows(
        lines.join(twice, "order_id", "left")
    )
    assert rows(expand_join(twice, lines, "order_id", skew=SPREAD)) == rows(
        twice.join(lines, "order_id", "left")
    )


def test_spread_join_on_two_keys(spark, no_broadcast):
    many = spark.range(200).selectExpr("id % 2 AS a", "id % 3 AS b", "id")
    one = spark.range(3).selectExpr("id AS a", "id AS b", "id AS name")
    assert rows(lookup_join(many, one, ["a", "b"], skew=Skew(0, 10, 4))) == rows(
        many.join(one, ["a", "b"], "left")
    )


def test_a_hot_key_is_spread_over_partitions(lines, orders, no_broadcast, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookup_join(lines, orders, "order_id", skew=SPREAD)
        parts = found.filter("order_id = 7").select(F.spark_partition_id().alias("p")).distinct()
        assert parts.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_lookup_tables_are_broadcast(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").withColumnRenamed(
        "n_nationkey", "l_linenumber"
    )
    plan = plan_of(lookup_join(lines, nation, "l_linenumber"))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_large_lookup_tables_are_not(spark, sf_dir, no_broadcast):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnRenamed(
        "o_orderkey", "l_orderkey"
    )
    assert "SortMergeJoin" in plan_of(lookup_join(lines, orders, "l_orderkey"))
