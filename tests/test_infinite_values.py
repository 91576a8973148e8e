"""Infinite values, and published types that would cut values."""

from __future__ import annotations

import math

import pytest

from martflow.operators.profile import histograms
from martflow.operators.quantiles import exact_quantiles
from martflow.sources.catalog import merged_schema


def test_quantiles_rank_infinities_apart(spark):
    values = [-math.inf, -math.inf, 1.0, 2.0, 1e300, 5.0, math.inf, math.nan, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    for p in (0, 0.2, 0.25, 0.5, 0.75, 0.9, 1):
        rank = max(1, math.ceil(p * len(ordered) - 1e-9))
        assert exact_quantiles(df, "x", [p]) == [ordered[rank - 1]]


def test_quantiles_of_nothing_finite(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,)], "x double")
    assert exact_quantiles(df, "x", [0.25, 0.75]) == [-math.inf, math.inf]


def test_histogram_leaves_infinities_out(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 9.0, 10.0, math.inf, -math.inf)], "x double")
    found = [tuple(r) for r in histograms(df, bins=2).orderBy("bin").collect()]
    assert sum(r[-1] for r in found) == 4 and {r[-1] for r in found} == {2}


def test_published_types_must_hold_new_values(spark):
    def schema(ddl):
        return spark.createDataFrame([], ddl).schema

    for old, new in (("x bigint", "x int"), ("x double", "x int"), ("x string", "x double"), ("x int", "x int, y int")):
        assert merged_schema(schema(old), schema(new))["x"] == schema(old)["x"]
    for old, new in (("x int", "x bigint"), ("x decimal(5,2)", "x decimal(6,3)"), ("x float", "x double")):
        assert merged_schema(schema(old), schema(new))["x"] == schema(new)["x"]
    for old, new in (("x int", "x double"), ("x date", "x timestamp"), ("x double", "x decimal(5,2)"), ("x int", "x string")):
        with pytest.raises(ValueError, match="cannot hold"):
            merged_schema(schema(old), schema(new))
