"""Casting to contract types, in one projection per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.contract import ColumnRule

# Contract type names and the Spark types they stand for.
CONTRACT_TYPES = {
    "int": "int",
    "string": "string",
    "float": "double",
    "datetime": "date",
}

AUDIT_COLUMNS = ("source", "timestamp", "extraction_id")

# Columns that several tables share and that get a table prefix.
SHARED_COLUMNS = (
    "first_name",
    "last_name",
    "phone",
    "email",
    "street",
    "city",
    "state",
    "zip_code",
)


def target_types(rules: Sequence[ColumnRule], int_type: str = "int") -> dict[str, str]:
    """Column name to Spark type; columns of an unknown type are left out.

    ``int_type="bigint"`` is meant for tables whose keys outgrow 32 bits: under
    ``int`` such keys fail the cast and turn into NULL.
    """
    names = {**CONTRACT_TYPES, "int": int_type}
    return {r.table_columns: names[r.datatype] for r in rules if r.datatype in names}


def cast_to_contract(
    df: DataFrame, rules: Sequence[ColumnRule], int_type: str = "int"
) -> DataFrame:
    types = target_types(rules, int_type)
    return df.select(
        *(F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns)
    )


def cast_report(
    df: DataFrame, rules: Sequence[ColumnRule], table: str, int_type: str = "int"
) -> DataFrame:
    """One row per contract column: target type, values present, values lost.

    Columns whose type the contract does not define have ``target = NULL``.
    """
    types = target_types(rules, int_type)
    entries = []
    for rule in rules:
        name = rule.table_columns
        if name not in df.columns:
            continue
        target = types.get(name)
        lost = F.lit(False)
        if target is not None:
            lost = F.col(name).isNotNull() & F.col(name).try_cast(target).isNull()
        entries.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit(target).cast("string").alias("target"),
                F.count(F.col(name)).alias("present"),
                F.count_if(lost).alias("failed"),
            )
        )
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def prefixed_name(table: str, column: str) -> str:
    return f"{table}_{column}" if column in SHARED_COLUMNS else column


def prefix_shared_columns(df: DataFrame, table: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefixed_name(table, c) for c in df.columns})


def drop_audit_columns(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)
