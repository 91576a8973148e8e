"""Whole runs: landing files to Staging 1, and on to the published mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contract import ColumnRule, Contract
from martflow.operators.casting import prefixed_name
from martflow.operators.joins import DEFAULT_SKEW, Skew
from martflow.operators.profile import profile_tables
from martflow.operators.quality import (
    REASON,
    STEPS,
    VIOLATIONS,
    StepCounts,
    key_report,
    require_valid_keys,
    split_by_key,
)
from martflow.plans.mart import Thresholds, build_mart
from martflow.plans.recipes import RECIPES, Setting, prefix_tables
from martflow.plans.star import DIMENSIONS, FACT, build_star, uncovered_dates
from martflow.sources.catalog import (
    create_managed,
    publish_external,
    register_tables,
    scan_table,
)
from martflow.sources.landing import load_landing, table_counts
from martflow.sources.layers import (
    DATA_MART,
    INFO_MART,
    REJECTS,
    REPORTS,
    STAGE1,
    STAGE2,
    Layers,
)
from martflow.sources.lookups import calendar_of, status_lookup
from martflow.sources.workdir import scratch

STAR_TABLES = (*DIMENSIONS, FACT)
DATE_LOOKUP, STATUS_LOOKUP = "date_lookup", "shipping_lookup"
MART_TABLE, PUBLISHED_TABLE = "sales_datamart", "sales_datamart_published"


@dataclass(frozen=True)
class Cleansed:
    """Staging 1 as stored, what was set aside, and the two reports of the run."""

    tables: dict[str, DataFrame]
    rejects: dict[str, DataFrame]
    keys: DataFrame
    steps: DataFrame


@dataclass(frozen=True)
class Run:
    """The published mart and the stored reports of a whole run; no profile if none was asked for."""

    mart: DataFrame
    cleansed: Cleansed
    dates: DataFrame
    profile: DataFrame | None


def run_profile(spark: SparkSession, layers: Layers, contract: Contract) -> DataFrame:
    return profile_tables(load_landing(spark, layers, contract))


def run_cleanse(
    spark: SparkSession, layers: Layers, setting: Setting, only: Sequence[str] | None = None
) -> Cleansed:
    """Landing to Staging 1, through the key gate.

    Every recipe runs once: its rows are written to a version that nobody reads yet, and the same job
    counts the rows after each step. Keys are checked on what was written. A table whose keys are sound is
    published as it is; of the others the rows at fault go to the rejects, or the run stops
    before anything is published.
    """
    raw = load_landing(spark, layers, setting.contract, setting.int_type)
    names = list(raw) if only is None else list(only)
    with scratch(spark):
        counts = {name: StepCounts(name) for name in names}
        cleansed = {
            name: RECIPES[name].watched(raw[name], setting, counts[name])
            if name in RECIPES
            else counts[name].watch("input", raw[name])
            for name in names
        }
        folders = layers.stage_all(prefix_tables(cleansed), STAGE1)
        stored = {name: layers.staged(spark, STAGE1, name, folders[name]) for name in names}
        steps = _steps(spark, raw, stored, counts, setting)
        keys = _checked_keys(spark, stored, setting)
        if setting.raise_on_bad_keys:
            require_valid_keys(keys)
        bad = {r["table_name"] for r in keys.filter("bad_rows > 0").select("table_name").collect()}
        rejects = {}
        for name in names:
            if name not in bad:
                rejects[name] = stored[name].limit(0).withColumn(REASON, F.lit(None).cast("string"))
                layers.publish(spark, STAGE1, name, folders[name])
                continue
            kept, rejects[name] = split_by_key(
                stored[name], _key_rules(setting, name), setting.int_type
            )
            layers.write(kept, STAGE1, name)
        layers.write_all(rejects, REJECTS)
        for name in bad:
            layers.drop_staged(spark, STAGE1, name, folders[name])
        layers.write_all({"keys": keys, "steps": steps}, REPORTS)
    return Cleansed(
        layers.read_all(spark, STAGE1, names),
        layers.read_all(spark, REJECTS, names),
        layers.read(spark, REPORTS, "keys"),
        layers.read(spark, REPORTS, "steps"),
    )


def _key_rules(setting: Setting, table: str) -> list[ColumnRule]:
    """The rules of a table's key, under the column names of Staging 1."""
    return [
        replace(r, table_columns=prefixed_name(table, r.table_columns))
        for r in setting.contract.primary_key(table)
    ]


def _checked_keys(
    spark: SparkSession, stored: Mapping[str, DataFrame], setting: Setting
) -> DataFrame:
    """Key checks on Staging 1, a few rows per table; empty if no table has a key."""
    rules = {name: _key_rules(setting, name) for name in stored}
    keyed = [name for name in stored if rules[name]]
    reports = [key_report(stored[name], rules[name], name, setting.int_type) for name in keyed]
    found = [tuple(r) for r in reduce(DataFrame.unionByName, reports).collect()] if reports else []
    return spark.createDataFrame(found, VIOLATIONS)


def _steps(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    stored: Mapping[str, DataFrame],
    counts: Mapping[str, StepCounts],
    setting: Setting,
) -> DataFrame:
    read = {r[0]: r[1] for r in table_counts({name: raw[name] for name in stored}).collect()}
    kept = {r[0]: r[1] for r in table_counts(stored).collect()}
    rows, again = [], []
    for name, seen in counts.items():
        if seen.agrees(read[name], kept[name]):
            rows += seen.rows()
        else:
            again.append(RECIPES[name].audit(raw[name], setting))
    return reduce(DataFrame.unionByName, again, spark.createDataFrame(rows, STEPS))


def run_key_report(
    spark: SparkSession, layers: Layers, setting: Setting
) -> DataFrame:
    """Key checks on the published tables of Staging 1."""
    return _checked_keys(spark, layers.read_all(spark, STAGE1, setting.contract.tables), setting)


def run_lookups(spark: SparkSession, layers: Layers, setting: Setting) -> None:
    """Staging 2; the calendar is that of the setting.

    Its first day may not differ from the one stored by an earlier run, as all date ids count from it.
    """
    calendar = setting.calendar
    if layers.exists(spark, STAGE2, DATE_LOOKUP):
        stored = calendar_of(layers.read(spark, STAGE2, DATE_LOOKUP))
        if stored.first != calendar.first:
            raise ValueError(f"date ids count from {stored.first}, not from {calendar.first}")
    layers.write(calendar.table(spark), STAGE2, DATE_LOOKUP)
    layers.write(status_lookup(spark), STAGE2, STATUS_LOOKUP)


def run_date_report(spark: SparkSession, layers: Layers, setting: Setting) -> DataFrame:
    """Per date of the stored orders, the rows whose day the calendar lacks."""
    return uncovered_dates(layers.read(spark, STAGE1, "orders"), setting.calendar)


def run_star(
    spark: SparkSession, layers: Layers, contract: Contract, skew: Skew = DEFAULT_SKEW
) -> dict[str, DataFrame]:
    stage1 = layers.read_all(spark, STAGE1, contract.tables)
    calendar = calendar_of(layers.read(spark, STAGE2, DATE_LOOKUP))
    statuses = layers.read(spark, STAGE2, STATUS_LOOKUP)
    layers.write_all(build_star(stage1, calendar, statuses, skew), INFO_MART)
    return layers.read_all(spark, INFO_MART, STAR_TABLES)


def run_mart(
    spark: SparkSession,
    layers: Layers,
    database: str,
    thresholds: Thresholds = Thresholds(),
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Register the star, build the mart from the catalog and publish it."""
    register_tables(spark, layers, database, STAR_TABLES)
    star = {name: scan_table(spark, database, name) for name in STAR_TABLES}
    calendar = calendar_of(star["date_dim"])
    with scratch(spark):
        mart = create_managed(
            build_mart(star, thresholds, skew=skew, calendar=calendar), database, MART_TABLE
        )
    return publish_external(
        mart, database, PUBLISHED_TABLE, layers.path(DATA_MART, MART_TABLE), layers.format
    )


def run_all(
    spark: SparkSession,
    layers: Layers,
    setting: Setting,
    database: str,
    thresholds: Thresholds = Thresholds(),
    skew: Skew = DEFAULT_SKEW,
    profile: bool = True,
) -> Run:
    """A whole run in order: profile of the landing files, cleansing, lookups, star, mart.

    Every layer is stored once, and so are the reports.
    """
    if profile:
        layers.write(run_profile(spark, layers, setting.contract), REPORTS, "profile")
    cleansed = run_cleanse(spark, layers, setting)
    run_lookups(spark, layers, setting)
    layers.write(run_date_report(spark, layers, setting), REPORTS, "dates")
    run_star(spark, layers, setting.contract, skew)
    mart = run_mart(spark, layers, database, thresholds, skew)
    return Run(
        mart,
        cleansed,
        layers.read(spark, REPORTS, "dates"),
        layers.read(spark, REPORTS, "profile") if profile else None,
    )
