"""Duplicate removal with a survivor that does not depend on row order.

The survivor is the first row of its key under a total order: the columns
asked for, then every other column. Spark turns the ``row_number = 1`` filter
into a group limit before the shuffle, so that each map task sends at most one
row per key; a key that holds a third of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def dedupe(
    df: DataFrame,
    keys: str | Sequence[str],
    *,
    order_by: Sequence[str] = (),
    keep_null_keys: bool = False,
) -> DataFrame:
    """Keep one row per key. NULL keys are one group unless they are all kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if keep_null_keys:
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        return dedupe(df.filter(~missing), keys, order_by=order_by).unionByName(df.filter(missing))
    order = [*order_by, *(c for c in df.columns if c not in order_by and c not in keys)]
    if not order:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_first() for c in order))
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe_chain(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """Dedupe on each column in turn; the sequence of columns is significant."""
    for column in columns:
        df = dedupe(df, column, **options)
    return df
