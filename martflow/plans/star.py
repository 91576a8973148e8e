"""The star: six dimensions and one fact with a row per order line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators.casting import drop_audit_columns
from martflow.operators.joins import (
    DEFAULT_SKEW,
    Skew,
    expand_join,
    lookup_join,
)
from martflow.sources.lookups import Calendar

FACT = "order_fact"
DIMENSIONS = (
    "customers_dim",
    "date_dim",
    "products_dim",
    "staffs_dim",
    "stores_dim",
    "status_dim",
)
DATE_ROLES = ("order_date", "required_date", "shipped_date")


def plain_dim(df: DataFrame) -> DataFrame:
    """A cleansed table as it is, without its audit columns."""
    return drop_audit_columns(df)


def date_dim(dates: DataFrame) -> DataFrame:
    day = F.col("date")
    return dates.select(
        "date",
        "date_id",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def products_dim(
    products: DataFrame,
    brands: DataFrame,
    categories: DataFrame,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """Products with the names of their brand and category in place of the ids."""
    named = plain_dim(products)
    for key, names in (("brand_id", brands), ("category_id", categories)):
        named = lookup_join(named, plain_dim(names), key, base=products, skew=skew)
    return named.drop("brand_id", "category_id")


def with_date_ids(
    df: DataFrame, calendar: Calendar, roles: tuple[str, ...] = DATE_ROLES
) -> DataFrame:
    """Replace each date by its id, computed from the day; NULL for days that the calendar lacks."""
    ids = {f"{role}_id": calendar.date_id(F.col(role)) for role in roles}
    return df.withColumns(ids).drop(*roles)


def uncovered_dates(
    df: DataFrame, calendar: Calendar, roles: tuple[str, ...] = DATE_ROLES
) -> DataFrame:
    """Per date column: rows with a date, and those whose day the calendar lacks."""
    entries = [
        F.struct(
            F.lit(role).alias("column_name"),
            F.count(role).alias("dated"),
            F.count_if(F.col(role).isNotNull() & calendar.date_id(F.col(role)).isNull()).alias(
                "uncovered"
            ),
        )
        for role in roles
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def order_lines(orders: DataFrame, items: DataFrame, skew: Skew = DEFAULT_SKEW) -> DataFrame:
    """Orders with their lines; an order without lines keeps one row."""
    lines = drop_audit_columns(items)
    # the line's number tells equal lines of a hot order apart until they are joined
    return expand_join(drop_audit_columns(orders), lines, "order_id", skew=skew).drop("item_id")


def order_fact(
    orders: DataFrame, items: DataFrame, calendar: Calendar, skew: Skew = DEFAULT_SKEW
) -> DataFrame:
    # Ids are computed per order, before the orders are multiplied by lines.
    return order_lines(with_date_ids(orders, calendar), items, skew)


def build_star(
    stage1: Mapping[str, DataFrame],
    calendar: Calendar,
    statuses: DataFrame,
    skew: Skew = DEFAULT_SKEW,
) -> dict[str, DataFrame]:
    return {
        "customers_dim": plain_dim(stage1["customers"]),
        "date_dim": date_dim(calendar.table(statuses.sparkSession)),
        "products_dim": products_dim(
            stage1["products"], stage1["brands"], stage1["categories"], skew
        ),
        "staffs_dim": plain_dim(stage1["staffs"]),
        "stores_dim": plain_dim(stage1["stores"]),
        "status_dim": plain_dim(statuses),
        FACT: order_fact(stage1["orders"], stage1["order_items"], calendar, skew),
    }
