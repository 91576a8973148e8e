"""Profiling as report tables: one pass for all columns wherever that is possible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.bits import FILTER_BITS, _bit_filter, _bit_is_set, with_hit  # noqa: F401
from martflow.functions.sizing import input_bytes
from martflow.operators.joins import DEFAULT_SKEW

# Size of the printed distribution and of the histogram.
DISTRIBUTION_ROWS = 10
HISTOGRAM_BINS = 30

#: Rows that are read to bound the first values of a large table.
BOUND_ROWS = 4096


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _is_day(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _report(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One aggregate row with an entry per column, turned into rows."""
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def schema_listing(df: DataFrame) -> DataFrame:
    """Column, position, type and number of values present."""
    return _report(
        df,
        [
            F.struct(
                F.lit(number).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.count(F.col(field.name)).alias("present"),
            )
            for number, field in enumerate(df.schema.fields)
        ],
    )


def describe(df: DataFrame) -> DataFrame:
    """Count, NULLs, mean, deviation, least and greatest value of each column.

    Least and greatest are given as numbers for numeric columns and as text for
    texts and dates; mean and deviation only exist for numbers.
    """
    entries = []
    for field in df.schema.fields:
        x, number = _name(field.name), "cast(NULL AS double)"
        found = dict.fromkeys(("mean", "sd", "min_number", "max_number"), number)
        found |= dict.fromkeys(("min_text", "max_text"), "cast(NULL AS string)")
        if _is_number(field):
            number = f"cast({x} AS double)"
            found |= {"mean": f"avg({number})", "sd": f"stddev_samp({number})"}
            found |= {"min_number": f"min({number})", "max_number": f"max({number})"}
        elif _is_text(field) or _is_day(field):
            found |= {f"{f}_text": f"cast({f}({x}) AS string)" for f in ("min", "max")}
        found = {"present": f"count({x})", "nulls": f"count_if({x} IS NULL)"} | found
        values = ", ".join(f"{value} AS {name}" for name, value in found.items())
        entries.append(f"struct({_text(field.name)} AS column_name, {values})")
    return _sql_report(df, entries)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_report(df: DataFrame, entries: Sequence[str]) -> DataFrame:
    """``_report`` of SQL texts: one expression to build, however many columns there are."""
    return df.agg(F.expr(f"array({', '.join(entries)})").alias("entries")).select(F.inline("entries"))


def null_counts(df: DataFrame) -> DataFrame:
    return _report(
        df,
        [
            F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls"))
            for c in df.columns
        ],
    )


def distinct_counts(df: DataFrame, approximate: bool = False, error: float = 0.01) -> DataFrame:
    """Distinct values per column, to see which columns could be unique.

    The exact count groups once by (column, value), which spreads every column
    over the cluster; the approximate one is a single aggregate.
    """
    if approximate:
        return _report(
            df,
            [
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.approx_count_distinct(c, error).alias("distinct_values"),
                )
                for c in df.columns
            ],
        )
    pairs = _pairs(df, df.columns).groupBy("column_name", "value").agg(F.lit(1).alias("one"))
    return pairs.groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def duplicate_rows(df: DataFrame, hash_first_bytes: int = DEFAULT_SKEW.min_bytes) -> DataFrame:
    """One row: groups of equal rows and the surplus rows in them.

    Grouping a large table by all of its columns would shuffle the whole table to
    find what most often are few duplicates. From ``hash_first_bytes`` on only
    64-bit hashes are shuffled, combined in the map tasks. The hashes that occur more than once set bits in a
    filter of a fixed size, which is broadcast; rows that pass it are combined with their equals in
    the map tasks and then grouped by their columns, which makes the count exact. So a row that is
    repeated a million times is sent once per task, and rows without an equal hardly ever.
    """
    rows = df
    if input_bytes(df) >= hash_first_bytes:
        row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
        hashes = df.select(row_hash.alias("__hash")).groupBy("__hash")
        repeated = hashes.agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > 1)
        rows = with_hit(df, "__hit", row_hash, repeated.select("__hash")).filter("__hit")
    groups = rows.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias("__rows"))
    repeated = groups.filter(F.col("__rows") > 1)
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def distribution(df: DataFrame, column: str, rows: int = DISTRIBUTION_ROWS) -> DataFrame:
    """The first values in value order, NULL first, with their counts."""
    return value_counts(df, column).orderBy(F.col("value").asc_nulls_first()).limit(rows)


def top_values(df: DataFrame, column: str, rows: int = DISTRIBUTION_ROWS) -> DataFrame:
    """The most frequent values; equal counts are ordered by value."""
    return (
        value_counts(df, column)
        .orderBy(F.desc("rows"), F.col("value").asc_nulls_first())
        .limit(rows)
    )


def distributions(
    df: DataFrame, rows: int = DISTRIBUTION_ROWS, bound_first_bytes: int = DEFAULT_SKEW.min_bytes
) -> DataFrame:
    """``distribution`` of every text column in one group-by.

    In tables from ``bound_first_bytes`` on, a few rows are read first: the value in place ``rows`` among
    them lies at or behind that of the whole table, so that greater values need not be grouped.
    """
    texts = [f.name for f in df.schema.fields if _is_text(f)]
    bounds: dict[str, str] = {}
    if texts and input_bytes(df) >= bound_first_bytes:
        some = df.select(*(F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(texts))).limit(BOUND_ROWS)
        places = [F.get(F.array_sort(F.collect_set(str(i))), F.lit(rows - 1)) for i in range(len(texts))]
        found = some.agg(*places).first()
        bounds = {c: found[i] for i, c in enumerate(texts) if found[i] is not None}
    counts = (
        _pairs(df, texts, bounds).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    order = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_first())
    return (
        counts.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= rows)
        .select("column_name", "place", "value", "rows")
    )


def histograms(
    df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width bins between the least and the greatest value, per column.

    Numbers are taken as they are, dates as days. All columns share one scan for
    the limits and one for the counts; empty bins are listed with zero rows.
    NULL, NaN and infinities fall in no bin.
    """
    axes = {
        f.name: f"CASE WHEN abs({_axis(f)}) < double('infinity') THEN {_axis(f)} END"
        for f in df.schema.fields
        if (columns is None or f.name in columns) and (_is_number(f) or _is_day(f))
    }
    if not axes:
        raise ValueError("no numeric or date column to draw a histogram of")
    entries = ", ".join(
        f"struct({_text(name)} AS column_name, min({axis}) AS low, max({axis}) AS high)" for name, axis in axes.items()
    )
    limits = df.agg(F.expr(f"array({entries})").alias("limits"))
    limits = limits.select(F.posexplode("limits").alias("place", "limit")).select("place", "limit.*")
    pairs = ", ".join(f"struct({i} AS place, {axis} AS x)" for i, axis in enumerate(axes.values()))
    points = df.select(F.expr(f"inline(array({pairs}))")).filter(F.col("x").isNotNull())
    # One row per column of the table, so the broadcast has a fixed size. Columns go by their
    # place, and a place and bin by one number: rows are joined and grouped by integers.
    placed = points.join(F.broadcast(limits.select("place", "low", "high")), "place")
    share = (F.col("x") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    number = F.least(F.lit(bins - 1), F.floor(F.coalesce(share, F.lit(0.0)) * bins)).cast("int")
    cell = F.col("place") * bins
    counted = placed.groupBy((cell + number).alias("cell")).agg(F.count(F.lit(1)).alias("found"))
    grid = limits.filter(F.col("low").isNotNull()).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    grid = grid.withColumn("cell", cell + F.col("bin"))
    return grid.join(counted, "cell", "left").select(
        "column_name",
        "bin",
        "low",
        "high",
        F.coalesce("found", F.lit(0)).cast("bigint").alias("rows"),
    )


def profile_table(df: DataFrame, table: str) -> DataFrame:
    """The whole profile of a table as (table, column, finding, place, label, value) rows.

    * ``present`` and ``nulls`` of every column; ``mean``, ``sd``, ``min`` and ``max`` of numbers; ``min``
      and ``max`` of texts and days, as labels;
    * ``first_value``: the first values of a text column in value order, with their rows, by place;
    * ``bin``: the rows of each bin of a number or day, between its least and greatest value, by place;
    * ``duplicate_groups`` and ``surplus_rows`` of the table, under the column ``*``.

    Per column the lists are of fixed length, so the report grows with the columns and not with the rows.
    """
    fields = df.schema.fields
    numbers = [f.name for f in fields if _is_number(f)]
    ordered = [f.name for f in fields if _is_text(f) or _is_day(f)]
    column, number = F.col("column_name"), F.col("column_name").isin(numbers)
    limits = number | column.isin(ordered)
    findings = [
        _finding(column, "present", value=F.col("present")),
        _finding(column, "nulls", value=F.col("nulls")),
        F.when(number, _finding(column, "mean", value=F.col("mean"))),
        F.when(number, _finding(column, "sd", value=F.col("sd"))),
        F.when(limits, _finding(column, "min", None, F.col("min_text"), F.col("min_number"))),
        F.when(limits, _finding(column, "max", None, F.col("max_text"), F.col("max_number"))),
    ]
    parts = [
        describe(df).select(F.inline(F.array_compact(F.array(*findings)))),
        duplicate_rows(df).select(
            F.inline(
                F.array(
                    *(_finding("*", c, value=F.col(c)) for c in ("duplicate_groups", "surplus_rows"))
                )
            )
        ),
    ]
    if any(_is_text(f) for f in fields):
        first = _finding(F.col("column_name"), "first_value", F.col("place"), F.col("value"), F.col("rows"))
        parts.append(distributions(df).select(first.alias("x")).select("x.*"))
    if any(_is_number(f) or _is_day(f) for f in fields):
        bins = _finding(F.col("column_name"), "bin", F.col("bin"), value=F.col("rows"))
        parts.append(histograms(df).select(bins.alias("x")).select("x.*"))
    report = _union(parts)
    return report.select(F.lit(table).alias("table_name"), *report.columns)


def _finding(
    column: str | Column,
    name: str,
    place: Column | None = None,
    label: Column | None = None,
    value: Column | None = None,
) -> Column:
    return F.struct(
        (F.lit(column) if isinstance(column, str) else column).alias("column_name"),
        F.lit(name).alias("finding"),
        (F.lit(0) if place is None else place).cast("int").alias("place"),
        (F.lit(None) if label is None else label).cast("string").alias("label"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
    )


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([profile_table(df, name) for name, df in tables.items()])


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of the parts. Halves are joined, as each union is analysed with all below it."""
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _union(parts[:middle]).union(_union(parts[middle:]))


def _axis(field: T.StructField) -> str:
    x = _name(field.name)
    if _is_day(field):
        return f"cast(datediff(cast({x} AS date), date '1970-01-01') AS double)"
    return f"nanvl(cast({x} AS double), NULL)"


def _pairs(
    df: DataFrame, columns: Sequence[str], bounds: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows of (column, value as text), up to the column's bound where there is one."""
    bounds = bounds or {}

    def pair(c: str) -> Column:
        value = F.col(f"`{c}`").cast("string")
        entry = F.struct(F.lit(c).alias("column_name"), value.alias("value"))
        return F.when(value.isNull() | (value <= bounds[c]), entry) if c in bounds else entry

    entries = F.array(*(pair(c) for c in columns))
    return df.select(F.inline(F.array_compact(entries) if bounds else entries))
