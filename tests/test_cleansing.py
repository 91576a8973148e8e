from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.contract import Contract
from martflow.operators import nulls, quantiles
from martflow.operators.casting import cast_report, cast_to_contract, prefix_shared_columns
from martflow.operators.dedupe import dedupe, dedupe_chain
from martflow.operators.outliers import handle_outliers, iqr_fences, remove_outliers_chain
from martflow.operators.quantiles import exact_quantiles
from martflow.sources.workdir import store

RULES = Contract.of(
    [
        ("t", "t", "k", "int", "N", "Y", "Y"),
        ("t", "t", "name", "string", "Y", "N", "N"),
        ("t", "t", "price", "float", "Y", "N", "N"),
        ("t", "t", "day", "datetime", "Y", "N", "N"),
        ("t", "t", "odd", "money", "Y", "N", "N"),
    ]
)
NAN = float("nan")


# --- casting ---


def test_cast_covers_all_contract_types_and_leaves_others(spark):
    df = spark.createDataFrame(
        [("1", "a", "1.5", "2020-02-29", "9"), ("x", "b", "y", "2020-02-30", "8")],
        "k string, name string, price string, day string, odd string",
    )
    found = cast_to_contract(df, RULES.table("t"))
    assert dict(found.dtypes) == {
        "k": "int",
        "name": "string",
        "price": "double",
        "day": "date",
        "odd": "string",
    }
    assert [r["k"] for r in found.orderBy("name").collect()] == [1, None]
    report = {r["column_name"]: r for r in cast_report(df, RULES.table("t"), "t").collect()}
    assert [report[c]["failed"] for c in ("k", "name", "price", "day", "odd")] == [1, 0, 1, 1, 0]
    assert report["odd"]["target"] is None


def test_int_keys_beyond_32_bits_need_the_wide_type(spark):
    df = spark.createDataFrame([(2**40,)], "k bigint")
    assert cast_to_contract(df, RULES.table("t")).first()[0] is None
    assert cast_to_contract(df, RULES.table("t"), "bigint").first()[0] == 2**40


def test_prefix_only_shared_columns(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, email string, brand string")
    assert prefix_shared_columns(df, "staffs").columns == ["id", "staffs_email", "brand"]


# --- missing values ---


def test_markers_match_exactly_unless_asked(spark):
    words = ["unknown", "NA", "NA ", "na", "NAN", "NULL", "ok", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    exact = [r[0] for r in nulls.markers_to_null(df).collect()]
    assert exact == [None, None, "NA ", "na", None, None, "ok", None]
    loose = nulls.markers_to_null(df, trim=True, ignore_case=True)
    assert [r[0] for r in loose.collect()] == [None] * 6 + ["ok", None]


def test_fill_is_for_text_unless_a_default_is_given(spark):
    df = spark.createDataFrame([(None, None)], "name string, price double")
    assert nulls.fill_missing(df, ["name", "price"]).first() == ("unknown", None)
    filled = nulls.fill_missing(df, ["name", "price"], defaults={"price": 0.0})
    assert filled.first() == ("unknown", 0.0)


def test_drop_missing_takes_nan_for_missing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,)], "x double")
    assert rows(nulls.drop_missing(df, ["x"])) == [(1.0,)]


def test_cleansing_twice_is_cleansing_once(spark):
    df = spark.createDataFrame(
        [(1, "NA", 1.0), (2, None, None), (None, "x", 2.0)], "k int, name string, price double"
    )
    once = nulls.cleanse_nulls(df, RULES, "t")
    assert rows(once) == rows(nulls.cleanse_nulls(once, RULES, "t"))
    assert rows(once) == [(1, "unknown", 1.0), (2, "unknown", None)]


# --- duplicates ---


def test_dedupe_survivor_does_not_depend_on_row_order(spark):
    data = [("a", 3), ("a", 1), ("b", 2), (None, 5), (None, 4)]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "k string, v int").repartition(3)
        assert rows(dedupe(df, "k")) == [("a", 1), ("b", 2), (None, 4)]
        kept = dedupe(df, "k", keep_null_keys=True)
        assert rows(kept) == [("a", 1), ("b", 2), (None, 4), (None, 5)]


def test_dedupe_order_columns_come_first(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 3)], "k string, v int, w int")
    assert rows(dedupe(df, "k", order_by=["w"])) == [("a", 2, 3)]


def test_dedupe_chain_depends_on_the_sequence(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "x string, y int")
    assert rows(dedupe_chain(df, ["x", "y"])) == [("a", 1)]
    once = dedupe_chain(df, ["y", "x"])
    assert rows(once) == [("a", 1), ("b", 2)]
    assert rows(dedupe_chain(once, ["y", "x"])) == rows(once)


def test_dedupe_sends_one_row_per_key_and_task(spark, sf_dir):
    plan = plan_of(dedupe(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey"))
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


# --- quantiles and outliers ---


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.floats(allow_nan=False, allow_infinity=False) | st.sampled_from([0.0, 1.0, -1e300, 1e300]),
        min_size=1,
        max_size=60,
    ),
    p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 1.0]),
)
def test_quantile_is_the_value_at_its_rank(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rank = max(1, math.ceil(round(p * len(values), 9)))
    assert exact_quantiles(df, "x", [p], bins=4) == [sorted(values)[rank - 1]]


def test_several_quantiles_at_once(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    found = exact_quantiles(df, "x", [0.01, 0.25, 0.251, 0.5, 0.5, 0.999], bins=8)
    assert found == [10.0, 250.0, 251.0, 500.0, 500.0, 999.0]


class _Scans:
    """Counts the jobs that bring rows to the driver."""

    def __init__(self, monkeypatch):
        self.taken = 0
        for name in ("collect", "first"):
            plain = getattr(DataFrame, name)

            def counted(df, plain=plain):
                self.taken += self.open == 0
                self.open += 1
                try:
                    return plain(df)
                finally:
                    self.open -= 1

            monkeypatch.setattr(DataFrame, name, counted)
        self.open = 0


@pytest.mark.parametrize("infinite", [0, 700])
def test_three_scans_find_quantiles_of_skewed_values(spark, monkeypatch, infinite):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.lognormal(3, 2.5, 40_000), [math.inf] * infinite, [-math.inf] * (infinite // 2)])
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(6).cache()
    df.count()
    asked = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9999, 1.0]
    ordered = np.sort(values)
    wanted = [float(ordered[max(1, math.ceil(Fraction(str(p)) * len(values))) - 1]) for p in asked]
    scans = _Scans(monkeypatch)
    assert exact_quantiles(df, "x", asked) == wanted
    assert scans.taken <= 3
    # coarse sketches and short lists take more scans, and give the same
    assert exact_quantiles(df, "x", asked, bins=7, accuracy=5, most_values=10) == wanted
    df.unpersist()


def test_a_bracket_that_misses_its_rank_is_replaced(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_sides", lambda accuracy: (0.3, 0.4))
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, "x", [0.1, 0.25, 0.5]) == [99.0, 249.0, 499.0]


def test_chain_plans_grow_by_one_range_per_column(spark):
    names = [f"c{i}" for i in range(8)]
    df = spark.range(200).select(*((F.col("id") * (i + 1) % 97).cast("double").alias(c) for i, c in enumerate(names)))
    df = store(df)
    sizes = [len(remove_outliers_chain(df, names[:n], 1.5)._jdf.queryExecution().toString()) for n in (2, 4, 8)]
    assert sizes[2] - sizes[1] < 3 * (sizes[1] - sizes[0])
    assert "subquery" not in remove_outliers_chain(df, names, 1.5)._jdf.queryExecution().toString().lower()


def test_chain_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert remove_outliers_chain(df, ["a", "b"]).count() == 0


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(NAN,), (1.0,), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.25, 0.75]) == [1.0, 1.0]
    assert exact_quantiles(df.filter("x IS NULL"), "x", [0.5]) == []
    with pytest.raises(ValueError):
        exact_quantiles(df, "x", [1.5])


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("method", ["iqr", "zscore", "Z-Score"])
def test_column_without_spread_has_no_outliers(spark, method):
    df = frame(spark, 5.0, 5.0, None)
    assert rows(handle_outliers(df, "x", method)) == [(5.0,), (5.0,)]
    kept = handle_outliers(df, "x", method, keep_nulls=True)
    assert rows(kept) == [(5.0,), (5.0,), (None,)]
    assert rows(handle_outliers(df, "x", method, "cap")) == [(5.0,), (5.0,), (None,)]


@pytest.mark.parametrize("method", ["iqr", "zscore"])
def test_single_row_and_no_values(spark, method):
    assert rows(handle_outliers(frame(spark, 1.0), "x", method)) == [(1.0,)]
    empty = frame(spark, None, None)
    assert rows(handle_outliers(empty, "x", method)) == []
    assert rows(handle_outliers(empty, "x", method, "cap")) == [(None,), (None,)]


def test_nan_is_left_out_of_the_statistics(spark):
    df = frame(spark, NAN, 1.0, 2.0, 3.0)
    assert rows(handle_outliers(df, "x", "zscore")) == [(1.0,), (2.0,), (3.0,)]
    assert iqr_fences(df, "x") == (1.0 - 3.0, 3.0 + 3.0)


@pytest.mark.parametrize("method", ["iqr", "zscore"])
def test_cap_keeps_rows_and_stays_within_fences(spark, method):
    df = spark.range(100).select(
        F.when(F.col("id") == 0, 10_000).otherwise(F.col("id")).cast("int").alias("x")
    )
    removed = handle_outliers(df, "x", method)
    capped = handle_outliers(df, "x", method, "cap")
    assert removed.count() == 99
    assert capped.count() == 100
    assert capped.schema["x"].dataType.simpleString() == "double"
    assert capped.agg(F.max("x")).first()[0] < 10_000


def test_unknown_arguments_have_their_own_messages(spark):
    with pytest.raises(ValueError, match="method"):
        handle_outliers(frame(spark, 1.0), "x", "median")
    with pytest.raises(ValueError, match="strategy"):
        handle_outliers(frame(spark, 1.0), "x", "iqr", "hide")


def test_chain_takes_statistics_on_survivors(spark):
    values = [(float(i % 10), float(i % 7)) for i in range(60)] + [(1000.0, 0.0), (5.0, 400.0)]
    df = spark.createDataFrame(values, "a double, b double")
    expected = handle_outliers(
        store(handle_outliers(df, "a", "zscore")), "b", "zscore"
    )
    for kept in (None, store):
        assert rows(remove_outliers_chain(df, ["a", "b"], store=kept)) == rows(expected)


def test_fences_are_subqueries_not_joins(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(handle_outliers(events, "value", "zscore"))
    assert "Subquery" in plan
    assert "Join" not in plan
