"""The storage layers, whose tables are replaced as a whole and never in place.

A table is a folder of versions and a manifest. A write goes to a fresh version, and only when all its files
are there is the version named in the manifest, by one appended row. Readers take the last
version named, so a write that dies leaves the old table as it was, and queries that run on the old
files can end. Old versions are emptied by ``retain``. Landing files come from others and are plain folders;
a format with a log of its own (Delta) replaces tables by that.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martflow.sources.workdir import discard

# Layer folders, from raw files to the report table, and beside them.
LANDING, STAGE1, STAGE2, INFO_MART, DATA_MART = (
    "landing",
    "stage1",
    "stage2",
    "infomart",
    "datamart",
)
REJECTS, REPORTS = "rejects", "reports"

MANIFEST = "_versions"
_MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("removed", T.BooleanType()),
    ]
)

WRITERS = 4


@dataclass(frozen=True)
class Layers:
    """Table paths under one root; the file format is a parameter."""

    root: str
    format: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def versioned(self, layer: str) -> bool:
        return layer != LANDING and self.format != "delta"

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> None:
        """Replace a table, schema included. Running it again gives the same table."""
        if self.versioned(layer):
            self.publish(df.sparkSession, layer, table, self.stage(df, layer, table, partition_by))
            return
        writer = df.write.format(self.format).mode("overwrite")
        if self.format == "delta":
            writer = writer.option("overwriteSchema", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.path(layer, table))

    def stage(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> str:
        """Write a version that nobody reads yet; its folder."""
        folder = f"v-{uuid.uuid4().hex}"
        writer = df.write.format(self.format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{self.path(layer, table)}/{folder}")
        return folder

    def staged(self, spark: SparkSession, layer: str, table: str, folder: str) -> DataFrame:
        return spark.read.format(self.format).load(f"{self.path(layer, table)}/{folder}")

    def publish(self, spark: SparkSession, layer: str, table: str, folder: str) -> None:
        """Make a staged version the current one."""
        self._note(spark, layer, table, [(time.time_ns(), folder, False)])

    def drop_staged(self, spark: SparkSession, layer: str, table: str, folder: str) -> None:
        discard(spark, f"{self.path(layer, table)}/{folder}")

    def _note(self, spark: SparkSession, layer: str, table: str, entries: list[tuple]) -> None:
        rows = spark.createDataFrame(entries, _MANIFEST_SCHEMA).coalesce(1)
        rows.write.mode("append").json(f"{self.path(layer, table)}/{MANIFEST}")

    def versions(self, spark: SparkSession, layer: str, table: str) -> list[tuple[int, str]]:
        """Versions that hold rows, the current one first; none if the table was never written."""
        try:
            manifest = spark.read.schema(_MANIFEST_SCHEMA).json(f"{self.path(layer, table)}/{MANIFEST}")
        except AnalysisException:
            return []
        # a row per write of this table
        entries = [tuple(r) for r in manifest.collect()]
        removed = {folder for _, folder, gone in entries if gone}
        known = [(version, folder) for version, folder, _ in entries if folder not in removed]
        return sorted(known, reverse=True)

    def location(self, spark: SparkSession, layer: str, table: str) -> str:
        """The folder that holds the current rows."""
        path = self.path(layer, table)
        if not self.versioned(layer):
            return path
        versions = self.versions(spark, layer, table)
        if not versions:
            raise FileNotFoundError(f"there is no table at {path}")
        return f"{path}/{versions[0][1]}"

    def retain(self, spark: SparkSession, layer: str, table: str, keep: int = 2) -> list[str]:
        """Empty all but the last *keep* versions; the folders that were emptied.

        The current version always stays. The emptied ones are noted before they go, so that
        a pass that dies is completed by the next.
        """
        old = self.versions(spark, layer, table)[max(1, keep) :]
        for _, folder in old:
            self.drop_staged(spark, layer, table, folder)
        if old:
            self._note(spark, layer, table, [(version, folder, True) for version, folder in old])
        return [folder for _, folder in old]

    def write_all(self, tables: Mapping[str, DataFrame], layer: str) -> None:
        """Write several tables side by side, so that small ones fill idle tasks."""
        self._side_by_side(self.write, tables, layer)

    def stage_all(self, tables: Mapping[str, DataFrame], layer: str) -> dict[str, str]:
        """Stage several tables side by side; the folder of each."""
        return self._side_by_side(self.stage, tables, layer)

    @staticmethod
    def _side_by_side(write, tables: Mapping[str, DataFrame], layer: str) -> dict:
        if not tables:
            return {}
        session = next(iter(tables.values())).sparkSession
        write = inheritable_thread_target(session)(write)
        with ThreadPoolExecutor(WRITERS) as pool:
            jobs = {name: pool.submit(write, df, layer, name) for name, df in tables.items()}
            return {name: job.result() for name, job in jobs.items()}

    def read(
        self, spark: SparkSession, layer: str, table: str, merge_schema: bool = False
    ) -> DataFrame:
        """``merge_schema`` is for folders whose files differ in their columns."""
        reader = spark.read.format(self.format)
        if merge_schema:
            reader = reader.option("mergeSchema", True)
        return reader.load(self.location(spark, layer, table))

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        """Whether a versioned table was ever written."""
        return bool(self.versions(spark, layer, table))

    def read_all(
        self, spark: SparkSession, layer: str, tables: Sequence[str]
    ) -> dict[str, DataFrame]:
        return {name: self.read(spark, layer, name) for name in tables}
