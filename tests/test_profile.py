from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from martflow.operators import profile

NAN = float("nan")


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(
        [
            (1, "b", 1.0, dt.date(2020, 1, 1), True),
            (2, "a", NAN, dt.date(2020, 1, 31), None),
            (2, "a", NAN, dt.date(2020, 1, 31), None),
            (4, None, None, None, False),
        ],
        "id int, name string, x double, day date, flag boolean",
    )


def test_describe(table):
    found = {r["column_name"]: r for r in profile.describe(table).collect()}
    assert (found["id"]["present"], found["id"]["mean"], found["id"]["max_number"]) == (4, 2.25, 4)
    assert (found["name"]["nulls"], found["name"]["min_text"]) == (1, "a")
    assert (found["day"]["min_text"], found["day"]["mean"]) == ("2020-01-01", None)
    assert (found["flag"]["present"], found["flag"]["nulls"]) == (2, 2)


def test_schema_listing_and_nulls(table):
    listed = profile.schema_listing(table).orderBy("position").collect()
    assert [(r["column_name"], r["data_type"]) for r in listed] == [
        ("id", "int"),
        ("name", "string"),
        ("x", "double"),
        ("day", "date"),
        ("flag", "boolean"),
    ]
    nulls = {r["column_name"]: r["nulls"] for r in profile.null_counts(table).collect()}
    assert nulls == {"id": 0, "name": 1, "x": 1, "day": 1, "flag": 2}


def test_duplicates_and_distinct(table):
    assert profile.duplicate_rows(table).first() == (1, 1)
    exact = dict(profile.distinct_counts(table).collect())
    assert exact == {"id": 3, "name": 2, "x": 2, "day": 2, "flag": 2}
    assert dict(profile.distinct_counts(table, approximate=True).collect()) == exact


def test_duplicates_found_by_hash_are_the_same(spark):
    df = spark.createDataFrame(
        [(0.0, "a"), (-0.0, "a"), (NAN, None), (NAN, None), (None, "a"), (1.0, "b")] * 2
        + [(2.0, "only")],
        "x double, s string",
    )
    expected = profile.duplicate_rows(df, hash_first_bytes=1 << 62).first()
    assert tuple(expected) == (4, 8)
    assert profile.duplicate_rows(df, hash_first_bytes=0).first() == expected


def test_distributions(spark):
    df = spark.range(100).select((F.col("id") % 26).cast("string").alias("s"))
    assert profile.distribution(df, "s").count() == 10
    assert profile.distribution(df, "s").first() == ("0", 4)
    top = [r["rows"] for r in profile.top_values(df, "s", 3).collect()]
    assert top == [4, 4, 4]
    together = profile.distributions(df).orderBy("place").collect()
    assert [(r["value"], r["rows"]) for r in together] == [
        tuple(r) for r in profile.distribution(df, "s").collect()
    ]


def test_histogram_counts_every_value_once(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    found = profile.histograms(df, bins=10).orderBy("bin").collect()
    assert [r["rows"] for r in found] == [10] * 9 + [11]


def test_histogram_edge_cases(table):
    found = profile.histograms(table, ["x", "day"], bins=4)
    assert rows(found.filter("rows > 0").select("column_name", "bin", "rows")) == [
        (0, "day", 1),
        (0, "x", 1),
        (3, "day", 2),
    ]
    assert found.count() == 8
    with pytest.raises(ValueError):
        profile.histograms(table, ["name"])


def test_histogram_of_no_values_is_empty(spark):
    assert profile.histograms(spark.sql("SELECT cast(NULL AS double) AS x")).count() == 0


def test_profile_table(table):
    report = profile.profile_table(table, "t").collect()
    found = {(r["column_name"], r["finding"], r["place"]): r for r in report}
    assert len(found) == len(report)
    assert found[("id", "max", 0)]["value"] == 4.0
    assert found[("id", "mean", 0)]["value"] == 2.25
    assert found[("name", "nulls", 0)]["value"] == 1.0
    assert found[("name", "max", 0)]["label"] == "b"
    assert found[("day", "min", 0)]["label"] == "2020-01-01"
    firsts = [found[("name", "first_value", n)] for n in (1, 2, 3)]
    assert [(r["label"], r["value"]) for r in firsts] == [(None, 1), ("a", 2), ("b", 1)]
    assert sum(r["value"] for r in report if r["finding"] == "bin" and r["column_name"] == "day") == 3
    assert found[("*", "duplicate_groups", 0)]["value"] == 1.0
    assert found[("flag", "present", 0)]["value"] == 2.0


def test_profile_of_an_empty_table(table):
    report = profile.profile_table(table.limit(0), "t").collect()
    assert {r["finding"] for r in report} == {
        "present", "nulls", "mean", "sd", "min", "max", "duplicate_groups", "surplus_rows",
    }
    assert all(not r["value"] for r in report)


def test_bounded_distributions_are_the_same(spark):
    """Values behind the bound are left out of the group-by, NULL and the first ones are not."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 50 > 0, F.sha2(F.col("id").cast("string"), 256)).alias("many"),
        (F.col("id") % 3).cast("string").alias("few"),
        F.lit(None).cast("string").alias("none.at all"),
    )
    plain = profile.distributions(df, bound_first_bytes=1 << 62)
    bounded = profile.distributions(df, bound_first_bytes=0)
    assert rows(bounded) == rows(plain)


def test_repeated_rows_are_combined_before_the_shuffle(spark):
    """One row 50,000 times, and 50,000 rows once: the filter lets through hardly any of the latter."""
    df = spark.range(0, 100_000, 1, 4).select(F.greatest("id", F.lit(50_000)).alias("x.y"), F.lit("s").alias("s"))
    found = profile.duplicate_rows(df, hash_first_bytes=0)
    assert tuple(found.first()) == (1, 50_000)
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    bits = profile._bit_filter(spark.range(1000).select(F.xxhash64("id").alias("__hash")))
    slots = spark.range(2000).select("id", (F.pmod(F.xxhash64("id"), F.lit(profile.FILTER_BITS)) + 1).alias("slot"))
    hit = slots.withColumn("__bucket", F.bitmap_bucket_number("slot")).join(bits, "__bucket").filter(
        profile._bit_is_set(F.col("__bits"), F.bitmap_bit_position("slot"))
    )
    ids = {r["id"] for r in hit.collect()}
    assert set(range(1000)) <= ids and len(ids) < 1010


def test_histograms_count_numbers_not_names(spark):
    """Values are grouped by one integer of their column and bin, whatever the columns are called."""
    df = spark.range(300).selectExpr(
        "cast(id AS double) AS `limits`", "id % 7 AS `x1`", "date '2020-01-01' + cast(id % 30 AS int) AS `cell`",
        "if(id < 3, NULL, id / 10) AS `a.b`", "cast(NULL AS int) AS none", "5 AS same",
    )
    found = profile.histograms(df, bins=6)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [column_name#" not in plan
    rows = {}
    for r in found.collect():
        rows.setdefault(r["column_name"], {})[r["bin"]] = r["rows"]
    assert set(rows) == {"limits", "x1", "cell", "a.b", "same"}
    assert {c: sum(b.values()) for c, b in rows.items()} == {"limits": 300, "x1": 300, "cell": 300, "a.b": 297, "same": 300}
    assert rows["same"] == {0: 300, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0}
    assert rows["x1"] == {n: sum(min(5, int((i % 7) / 6 * 6)) == n for i in range(300)) for n in range(6)}
