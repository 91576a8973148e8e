"""Registration of layer tables in the session catalog, and publication."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.sources.layers import INFO_MART, Layers


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def register_tables(
    spark: SparkSession,
    layers: Layers,
    database: str,
    tables: Sequence[str],
    layer: str = INFO_MART,
) -> None:
    """External tables over layer folders, always under their full name.

    A table that is there already is pointed to the current files, and registered anew if the
    stored schema is another one by now. Dropping an external table leaves its files alone.
    """
    create_database(spark, database)
    for table in tables:
        name = f"`{database}`.`{table}`"
        location = layers.location(spark, layer, table)
        if spark.catalog.tableExists(f"{database}.{table}"):
            stored = spark.read.format(layers.format).load(location)
            if spark.table(name).schema == stored.schema:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
                spark.catalog.refreshTable(f"{database}.{table}")
                continue
            spark.sql(f"DROP TABLE {name}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} "
            f"USING {layers.format} LOCATION '{location}'"
        )


def registered_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def scan_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns in their order, then those that are new.

    A column keeps its published type if that holds all values of the new one, and takes the wider
    number type of the two if not. Anything else is an error: values would be cut unnoticed.
    """
    fields = []
    for field in old.fields:
        if field.name in new.names:
            wide = merged_type(field.dataType, new[field.name].dataType)
            if wide is None:
                raise ValueError(
                    f"column {field.name} is published as {field.dataType.simpleString()}, "
                    f"which cannot hold {new[field.name].dataType.simpleString()}"
                )
            field = T.StructField(field.name, wide, field.nullable, field.metadata)
        fields.append(field)
    return T.StructType([*fields, *(f for f in new.fields if f.name not in old.names)])


def merged_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The published type if it holds the new one, else the least number type that holds both."""
    if _fits(new, old):
        return old
    if isinstance(old, T.FloatType) and isinstance(new, T.DoubleType):
        return new
    shapes = [_shape(t) for t in (old, new)]
    if None in shapes:
        return None
    if _fits(old, new):
        return new
    whole, scale = (max(part) for part in zip(*shapes))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _shape(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point of an exact number."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (_WHOLE[type(kind)], 0) if type(kind) in _WHOLE else None


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _fits(new: T.DataType, old: T.DataType) -> bool:
    """Whether every value of the new type is one of the old type."""
    if new == old or isinstance(new, T.NullType) or isinstance(old, T.StringType):
        return True
    kind = type(new)
    if kind in _WHOLE:
        digits = _WHOLE[kind]
        if type(old) in _WHOLE:
            return digits <= _WHOLE[type(old)]
        if isinstance(old, T.DecimalType):
            return digits <= old.precision - old.scale
        return isinstance(old, T.DoubleType) and digits < 16
    if kind is T.DecimalType and isinstance(old, T.DecimalType):
        return new.scale <= old.scale and new.precision - new.scale <= old.precision - old.scale
    return kind is T.FloatType and isinstance(old, T.DoubleType)


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns, by name; absent ones are NULL.

    A column that the target lacks is an error: it would be lost unnoticed.
    """
    surplus = [c for c in df.columns if c not in target.names]
    if surplus:
        raise ValueError(f"columns {surplus} are not in the target")
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        )
    )


def create_managed(df: DataFrame, database: str, table: str) -> DataFrame:
    """Replace a managed table by a query result."""
    spark = df.sparkSession
    name = f"`{database}`.`{table}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def publish_external(
    df: DataFrame, database: str, table: str, location: str, format: str = "parquet"
) -> DataFrame:
    """Replace the rows of an external table, by column name.

    New columns are added to the published schema, columns that are gone stay
    as NULL, and a column of numbers takes a wider type where the rows need it. Rows go to a fresh folder below ``location`` and the table is pointed
    to it afterwards: readers see the old rows until then, a failed write leaves
    them in place, and the rows may come from the published table itself.
    """
    spark = df.sparkSession
    full_name, name = f"{database}.{table}", f"`{database}`.`{table}`"
    version = f"{location.rstrip('/')}/version-{uuid.uuid4().hex}"
    if not spark.catalog.tableExists(full_name):
        df.write.format(format).save(version)
        spark.catalog.createTable(full_name, path=version, source=format, schema=df.schema)
        return spark.table(name)
    old = spark.table(name).schema
    schema = merged_schema(old, df.schema)
    conform(df, schema).write.format(format).save(version)
    if schema.fields[: len(old)] != old.fields:
        # the catalog cannot change a type; dropping an external table leaves its files alone
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(full_name, path=version, source=format, schema=schema)
        return spark.table(name)
    added = [f for f in schema.fields if f.name not in old.names]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.catalog.refreshTable(full_name)
    return spark.table(name)


def insert_overwrite(df: DataFrame, database: str, table: str) -> DataFrame:
    """Overwrite an existing table in place, by column name.

    The shorter way where the rows do not come from that table and its schema
    already has all columns.
    """
    spark = df.sparkSession
    target = spark.table(f"`{database}`.`{table}`").schema
    conform(df, target).write.insertInto(f"`{database}`.`{table}`", overwrite=True)
    return spark.table(f"`{database}`.`{table}`")
