"""Folders for tables that a run writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.sizing import input_bytes, inputs

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_STORED: ContextVar[list[str] | None] = ContextVar("stored", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session without the setting gets a folder of its own; on a
    cluster a folder of one machine would not survive, nor be seen by others.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="martflow-")
        spark.sparkContext.setCheckpointDir(folder)
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")


def run_folder(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, so that runs never overwrite each other."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write a table to the shared folder and read it back, which ends its lineage."""
    path = run_folder(df.sparkSession, name)
    known = _STORED.get()
    if known is not None:
        known.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_hand(df: DataFrame, name: str, min_bytes: int) -> DataFrame:
    """A table for several readers: stored, unless it is a single table already or made from little."""
    return store(df, name) if inputs(df) > 1 and input_bytes(df) >= min_bytes else df


def discard(spark: SparkSession, path: str) -> None:
    """Free the space of a folder of rows that nobody reads any more.

    DataFrames can replace a folder's files but not delete it, so that an empty table is left.
    """
    spark.range(0, 0, 1, numPartitions=1).write.mode("overwrite").parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables stored inside are discarded at the end, so nothing lazy that reads them may leave.

    Gives the list of their folders, in order; what is taken off it stays.
    """
    paths: list[str] = []
    token = _STORED.set(paths)
    try:
        yield paths
    finally:
        _STORED.reset(token)
        for path in paths:
            discard(spark, path)


def stays(path: str) -> None:
    """Leave a folder taken off the list of an inner :func:`scratch` to the outer one, if there is any."""
    known = _STORED.get()
    if known is not None:
        known.append(path)


@dataclass(frozen=True)
class Staged:
    """A stored table with its rows and their bytes in memory, as counted while it was written."""

    table: DataFrame
    rows: int
    size: int


def stage(df: DataFrame, name: str = "staged") -> Staged:
    """Store a table and measure it in the same job.

    The size is a measure of the rows themselves. Neither the files, which are compressed, nor what the
    table was made from, say how much a broadcast of it would take.
    """
    seen = Observation()
    table = store(
        df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).alias("size")), name
    )
    found = seen.get
    return Staged(table, found["rows"], found["size"] or 0)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row in memory: eight per column, and the lengths of texts and nested values."""
    size = F.lit(16).cast("bigint")
    for field in schema.fields:
        x = F.col(f"`{field.name}`")
        size = size + F.lit(8)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(x), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(8 * F.octet_length(x.cast("string")), F.lit(0))
    return size
