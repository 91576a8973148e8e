"""Size checks that stand before every broadcast of a table that can grow."""

from __future__ import annotations

from pyspark.sql import DataFrame


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that *df* reads, before any pruning.

    The sum over the inputs is used in place of the estimate for the whole
    plan: for a chain of lookup joins that estimate is the product of the sides
    and would call every derived dimension huge. Inputs without statistics
    count as unbounded. The analyzed plan is enough to find the inputs, so a
    check costs no optimizer run.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def inputs(df: DataFrame) -> int:
    """Number of tables that *df* reads."""
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


def broadcast_limit(df: DataFrame) -> int:
    """The session's own limit for broadcast tables (-1 turns broadcasts off)."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame, size: int | None = None) -> bool:
    """Whether *df* is below the limit, by its measured *size* if that is given."""
    limit = broadcast_limit(df)
    return limit > 0 and (input_bytes(df) if size is None else size) <= limit
