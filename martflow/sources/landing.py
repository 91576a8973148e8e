"""Landing files: one lazy scan per table of the contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contract import Contract
from martflow.operators.casting import cast_to_contract
from martflow.sources.layers import LANDING, Layers


def scan_landing(spark: SparkSession, layers: Layers, contract: Contract) -> dict[str, DataFrame]:
    return {
        table: layers.read(spark, LANDING, folder)
        for table, folder in contract.destinations.items()
    }


def load_landing(
    spark: SparkSession, layers: Layers, contract: Contract, int_type: str = "int"
) -> dict[str, DataFrame]:
    """Scan and cast every table of the contract."""
    return cast_tables(scan_landing(spark, layers, contract), contract, int_type)


def cast_tables(
    tables: dict[str, DataFrame], contract: Contract, int_type: str = "int"
) -> dict[str, DataFrame]:
    """Cast every table to its contract; also used again after cleansing."""
    return {
        name: cast_to_contract(df, contract.table(name), int_type)
        if name in contract.tables
        else df
        for name, df in tables.items()
    }


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, as one report."""
    counts = (
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)
