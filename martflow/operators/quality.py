"""Checks that report instead of print: keys, references, postal codes, steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.contract import ColumnRule, Contract
from martflow.operators.casting import target_types
from martflow.operators.dedupe import dedupe
from martflow.operators.joins import DEFAULT_SKEW, Skew, count_keys, lookup_join

VIOLATIONS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("bad_rows", T.LongType()),
    ]
)


# --- primary keys ------------------------------------------------------------


def _missing_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def key_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows and rows with a NULL in the key."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(_missing_key(keys)).alias("null_rows")
    )


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; NULL counts as a value."""
    return count_keys(df, keys).filter(F.col("rows") > 1)


def key_type_failures(df: DataFrame, rule: ColumnRule, int_type: str = "int") -> Column:
    """Count of rows whose key has no value of the declared type."""
    target = target_types([rule], int_type).get(rule.table_columns)
    if target is None:
        return F.lit(0).cast("bigint")
    return F.count_if(F.col(rule.table_columns).try_cast(target).isNull())


def key_report(
    df: DataFrame, rules: Sequence[ColumnRule], table: str, int_type: str = "int"
) -> DataFrame:
    """All three checks on the key that the flagged columns form together.

    One aggregate covers NULLs and types of all key columns, one group-by the
    uniqueness. ``bad_rows`` of the duplicate check counts the surplus rows.
    """
    keys = [r.table_columns for r in rules]
    label = ",".join(keys)
    entries = [
        _violation(table, r.table_columns, "null", F.count_if(F.col(r.table_columns).isNull()))
        for r in rules
    ] + [
        _violation(table, r.table_columns, "type", key_type_failures(df, r, int_type))
        for r in rules
    ]
    values = df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
    surplus = F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint")
    duplicates = key_duplicates(df, keys).agg(surplus.alias("bad_rows"))
    return values.unionByName(
        duplicates.select(
            F.lit(table).alias("table_name"),
            F.lit(label).alias("column_name"),
            F.lit("duplicate").alias("check_name"),
            "bad_rows",
        )
    )


def _violation(table: str, column: str, check: str, bad: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        bad.alias("bad_rows"),
    )


def pk_report(
    tables: Mapping[str, DataFrame], contract: Contract, int_type: str = "int"
) -> DataFrame:
    """Every key check of the contract; a table that is absent is a finding."""
    reports = []
    absent = []
    for name in contract.tables:
        rules = contract.primary_key(name)
        if not rules:
            continue
        if name in tables:
            reports.append(key_report(tables[name], rules, name, int_type))
        else:
            label = ",".join(r.table_columns for r in rules)
            absent.append((name, label, "missing table", None))
    if not reports:
        raise ValueError("none of the contract's keyed tables is present")
    report = reduce(DataFrame.unionByName, reports)
    if absent:
        report = report.unionByName(report.sparkSession.createDataFrame(absent, VIOLATIONS))
    return report


def require_valid_keys(report: DataFrame) -> None:
    """Raise if a report holds a violation (the report has a few rows per table)."""
    bad = report.filter((F.col("bad_rows") > 0) | F.col("bad_rows").isNull()).collect()
    if bad:
        found = "; ".join(
            f"{r['table_name']}({r['column_name']}): {r['check_name']} {r['bad_rows'] or ''}".strip()
            for r in bad
        )
        raise ValueError(f"primary key violations: {found}")


# --- key gate ----------------------------------------------------------------

# Why a row is turned away, in the order in which the reasons are tried.
REASON = "reject_reason"
NULL_KEY, BAD_TYPE, DUPLICATE = "null", "type", "duplicate"


def split_by_key(
    df: DataFrame, rules: Sequence[ColumnRule], int_type: str = "int", skew: Skew = DEFAULT_SKEW
) -> tuple[DataFrame, DataFrame]:
    """(rows with a sound key, rejected rows with their reason); together they are all rows.

    Rejected is a row whose key has a NULL or a value not of its declared type, and every row but the first
    of a key, in the order of ``dedupe``. Of equal rows one stays. Rejects are found among the rows
    of repeated keys alone, and no task holds all rows of a key: survivors are limited before
    their shuffle, repeated keys are combined in the map tasks, and their rows are joined and
    subtracted by value.
    """
    keys = [r.table_columns for r in rules]
    types = target_types(rules, int_type)
    lost = [F.col(k).try_cast(types[k]).isNull() for k in keys if k in types]
    wrong = reduce(lambda a, b: a | b, lost, F.lit(False))
    reason = F.when(_missing_key(keys), NULL_KEY).when(wrong, BAD_TYPE)
    sound = df.filter(reason.isNull())
    broken = df.filter(reason.isNotNull()).withColumn(REASON, reason)
    repeated = key_duplicates(sound, keys)
    group = lookup_join(sound, repeated.select(*keys), keys, counts=repeated, skew=skew, how="inner")
    group = group.select(*df.columns)
    surplus = group.exceptAll(dedupe(group, keys)).withColumn(REASON, F.lit(DUPLICATE))
    return dedupe(sound, keys), broken.unionByName(surplus)


# --- references --------------------------------------------------------------


def orphans(facts: DataFrame, foreign_key: str, dim: DataFrame, key: str) -> DataFrame:
    """Foreign key values without a partner, with their rows; NULL is no orphan.

    The facts are counted per value first, so the join sees each value once.
    """
    counts = count_keys(facts.filter(F.col(foreign_key).isNotNull()), [foreign_key])
    known = dim.select(F.col(key).alias(foreign_key))
    return counts.join(known, foreign_key, "left_anti")


def orphan_report(
    facts: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """``references``: foreign key -> (dimension name, dimension, its key)."""
    reports = []
    for foreign_key, (name, dim, key) in references.items():
        found = orphans(facts, foreign_key, dim, key).agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        )
        reports.append(
            found.select(
                F.lit(foreign_key).alias("column_name"),
                F.lit(name).alias("dim_name"),
                "orphan_keys",
                "orphan_rows",
            )
        )
    return reduce(DataFrame.unionByName, reports)


# --- postal codes ------------------------------------------------------------


def _five_digits(column: str) -> Column:
    return F.regexp_extract(F.trim(F.col(column)), r"^(\d{5})(-\d{4})?$", 1)


def _country_codes(postal: DataFrame, country: str) -> DataFrame:
    """Distinct five-digit codes of a country: at most 100,000 short strings."""
    five = F.col("postal_code").rlike(r"^\d{5}$")
    return (
        postal.filter((F.col("country_code") == country) & five)
        .select(F.col("postal_code").alias("__code"))
        .distinct()
    )


def valid_postal_codes(
    df: DataFrame, column: str, postal: DataFrame, country: str = "US"
) -> DataFrame:
    """Rows whose code, or the first half of a 5-4 code, is known in the country."""
    codes = F.broadcast(_country_codes(postal, country))
    return df.join(codes, _five_digits(column) == F.col("__code"), "left_semi")


def rejected_postal_codes(
    df: DataFrame, column: str, postal: DataFrame, country: str = "US"
) -> DataFrame:
    """The complement: unknown, malformed and missing codes."""
    codes = F.broadcast(_country_codes(postal, country))
    return df.join(codes, _five_digits(column) == F.col("__code"), "left_anti")


# --- vectorised predicates and step counts -----------------------------------


def filter_by_batch_predicate(
    df: DataFrame, column: str, predicate: Callable[[pd.Series], pd.Series]
) -> DataFrame:
    """Keep rows for which a pandas predicate holds, one Arrow batch at a time.

    For checks that Spark's own functions cannot express; everything else
    should be a column expression.
    """

    @F.pandas_udf(T.BooleanType())
    def check(values: pd.Series) -> pd.Series:
        return predicate(values)

    return df.filter(check(F.col(column)))


def step_audit(table: str, steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows after each named step, and rows lost or gained since the one before."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"),
            F.lit(number).alias("step_no"),
            F.lit(name).alias("step"),
            "rows",
        )
        for number, (name, df) in enumerate(steps)
    ]
    return reduce(DataFrame.unionByName, counts)


STEPS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("step_no", T.IntegerType()),
        T.StructField("step", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


class StepCounts:
    """Rows after each step of a table, counted by the job that writes it.

    Nothing runs for the counts. A map task that is run again after the loss of an executor counts its
    rows twice, so ``agrees`` compares the ends with what was read and stored; where it is
    false, ``step_audit`` counts anew.
    """

    def __init__(self, table: str):
        self.table = table
        self.steps: list[tuple[str, Observation]] = []

    def watch(self, step: str, df: DataFrame) -> DataFrame:
        seen = Observation()
        self.steps.append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> list[tuple[str, int, str, int]]:
        """Waits for the job that the table takes part in."""
        return [
            (self.table, number, step, seen.get["rows"])
            for number, (step, seen) in enumerate(self.steps)
        ]

    def agrees(self, read: int, stored: int) -> bool:
        """Steps only ever remove rows, between what was read and what was stored."""
        counts = [row[-1] for row in self.rows()]
        falls = all(a >= b for a, b in zip(counts, counts[1:], strict=False))
        return falls and counts[0] == read and counts[-1] == stored
