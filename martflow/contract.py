"""Column contracts: one rule per (table, column), read once, then plain Python.

The contract is bounded by the number of columns in the warehouse, never by
rows, so collecting it to the driver is safe at any data size.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The header of a contract file.
CONTRACT_COLUMNS = (
    "destination_filename",
    "source_table",
    "table_columns",
    "datatype",
    "nullable",
    "unique",
    "primary_key",
)

CONTRACT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CONTRACT_COLUMNS])


@dataclass(frozen=True)
class ColumnRule:
    destination_filename: str
    source_table: str
    table_columns: str
    datatype: str
    nullable: str | None = None
    unique: str | None = None
    primary_key: str | None = None


@dataclass(frozen=True)
class Contract:
    """All rules, in file order. The order of columns fixes the dedupe order."""

    rules: tuple[ColumnRule, ...]

    @classmethod
    def of(cls, rows: Iterable[tuple]) -> "Contract":
        return cls(tuple(ColumnRule(*row) for row in rows))

    @property
    def tables(self) -> list[str]:
        return list(dict.fromkeys(r.source_table for r in self.rules))

    @property
    def destinations(self) -> dict[str, str]:
        """Table name to landing folder; a table must map to exactly one."""
        folders: dict[str, str] = {}
        for rule in self.rules:
            known = folders.setdefault(rule.source_table, rule.destination_filename)
            if known != rule.destination_filename:
                raise ValueError(
                    f"table {rule.source_table!r} maps to both {known!r} "
                    f"and {rule.destination_filename!r}"
                )
        return folders

    def table(self, name: str) -> list[ColumnRule]:
        rules = [r for r in self.rules if r.source_table == name]
        if not rules:
            raise KeyError(f"no contract rules for table {name!r}")
        return rules

    def fillable(self, name: str) -> list[str]:
        return [r.table_columns for r in self.table(name) if r.nullable == "Y"]

    def required(self, name: str) -> list[str]:
        return [r.table_columns for r in self.table(name) if r.nullable == "N"]

    def unique(self, name: str) -> list[str]:
        return [r.table_columns for r in self.table(name) if r.unique == "Y"]

    def primary_key(self, name: str) -> list[ColumnRule]:
        return [r for r in self.table(name) if r.primary_key == "Y"]


def read_contract(spark: SparkSession, path: str) -> Contract:
    rows = spark.read.schema(CONTRACT_SCHEMA).option("header", True).csv(path).collect()
    return Contract.of(tuple(row) for row in rows)


def write_contract(spark: SparkSession, contract: Contract, path: str) -> None:
    """Write a contract as one CSV file, so that the rule order survives."""
    rows = [tuple(getattr(r, c) for c in CONTRACT_COLUMNS) for r in contract.rules]
    (
        spark.createDataFrame(rows, CONTRACT_SCHEMA)
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
