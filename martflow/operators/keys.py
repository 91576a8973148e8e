"""Surrogate keys for the distinct values of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.sources.workdir import store

_PART, _OFFSET = "__part", "__offset"


def surrogate_keys(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct values with ids 1, 2, 3 ... in value order.

    A numbering window over all values would sort them in one task. Here values
    are range-partitioned and stored with their partition number; ids then are
    the place within the partition plus the sizes of the partitions before it.
    Only those sizes, one row per partition, meet in one task.
    """
    values = df.select(*columns).distinct()
    parted = store(
        values.repartitionByRange(*columns).withColumn(_PART, F.spark_partition_id()), "values"
    )
    sizes = parted.groupBy(_PART).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART, F.coalesce(F.sum("size").over(before), F.lit(0)).alias(_OFFSET)
    )
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(*columns))
    return (
        parted.withColumn("__place", place)
        .join(F.broadcast(offsets), _PART)
        .select(*columns, (F.col(_OFFSET) + F.col("__place")).cast("bigint").alias(name))
    )
