"""Stored tables of operators that run several jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.sources import workdir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def held(df: DataFrame, *apart: str) -> Column:
    """All columns but those *apart* in one, so that none of their names can meet a name of the operator's."""
    rest = [F.col(_quoted(c)).alias(c) for c in df.columns if c not in apart]
    return F.struct(*rest) if rest else F.struct(F.lit(None).alias("none"))


def released(df: DataFrame, row: str, **apart: str) -> list[Column]:
    """The columns of *df* again, from the one that holds them and from those kept apart, by name."""
    return [
        (F.col(apart[c]) if c in apart else F.col(row).getField(c)).alias(c) for c in df.columns
    ]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The shuffle files of the write are removed as it ends. Left to itself Spark keeps them until the
    driver collects its garbage, so an operator of many jobs would hold the files of all of them.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return workdir.store(df, name)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
