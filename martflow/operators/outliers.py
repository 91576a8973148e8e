"""Outlier removal and capping by z-score or by interquartile range.

Z-score fences stay in the plan: a one-row aggregate used as a scalar subquery,
so nothing is joined and nothing runs before the caller's own action. IQR fences
need exact quantiles, which take a few small jobs (see ``quantiles``).

Statistics leave out NULL and NaN. A column without spread has no outliers;
a column without values has no fences. Removal drops NULL, capping keeps it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.operators.quantiles import exact_quantiles

# Fence widths and accepted names.
IQR_FACTOR = 1.5
Z_THRESHOLD = 3
METHODS = {"iqr": "iqr", "zscore": "zscore", "z-score": "zscore"}
STRATEGIES = ("remove", "cap")


def zscore_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: number of values, mean and sample standard deviation."""
    x = _number(column)
    return df.agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")
    )


def zscore_fences(df: DataFrame, column: str, threshold: float = Z_THRESHOLD) -> DataFrame:
    """One row (low, high); infinite where the column has no spread."""
    reach = F.lit(float(threshold)) * F.col("sd")
    spread = F.col("sd") > 0
    return zscore_stats(df, column).select(
        F.when(spread, F.col("mean") - reach)
        .when(F.col("n") > 0, F.lit(float("-inf")))
        .alias("low"),
        F.when(spread, F.col("mean") + reach)
        .when(F.col("n") > 0, F.lit(float("inf")))
        .alias("high"),
    )


def iqr_fences(df: DataFrame, column: str) -> tuple[float, float] | None:
    quartiles = exact_quantiles(df, column, [0.25, 0.75])
    if not quartiles:
        return None
    q1, q3 = quartiles
    reach = IQR_FACTOR * (q3 - q1)
    return q1 - reach, q3 + reach


def handle_outliers(
    df: DataFrame,
    column: str,
    method: str = "iqr",
    strategy: str = "remove",
    threshold: float = Z_THRESHOLD,
    keep_nulls: bool = False,
) -> DataFrame:
    kind = METHODS.get(method.lower())
    if kind is None:
        raise ValueError(f"unknown outlier method {method!r}; use one of {sorted(METHODS)}")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown outlier strategy {strategy!r}; use one of {STRATEGIES}")
    x = F.col(column)
    if kind == "iqr":
        fences = iqr_fences(df, column)
        low, high = (F.lit(None).cast("double"),) * 2 if fences is None else map(F.lit, fences)
        inside = x.between(low, high)
    else:
        bounds = zscore_fences(df, column, threshold).select(F.struct("low", "high")).scalar()
        low, high = bounds["low"], bounds["high"]
        inside = (x > low) & (x < high)
    if strategy == "remove":
        return df.filter(inside | x.isNull()) if keep_nulls else df.filter(inside)
    capped = F.when(x < low, low).when(x > high, high).otherwise(x.cast("double"))
    return df.withColumn(column, capped)


def remove_outliers_chain(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = Z_THRESHOLD,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Z-score removal on each column in turn, statistics on the survivors.

    Every step takes a job that scans its input for two numbers, so ``df`` should be a
    stored table; ``store`` may write the survivors between the steps. The numbers enter the plan as
    they are: it grows by one range per column, which is pushed to the scan, where
    fences as subqueries would each hold those before them.
    """
    for number, column in enumerate(columns):
        if number and store is not None:
            df = store(df)
        low, high = zscore_fences(df, column, threshold).first()
        x = F.col(column)
        # without values there are no fences, and every row is NULL or NaN
        df = df.filter(F.lit(False) if low is None else (x > F.lit(low)) & (x < F.lit(high)))
    return df


def _number(column: str) -> Column:
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)
