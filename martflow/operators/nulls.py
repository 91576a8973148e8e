"""Missing values: markers to NULL, fill what may be missing, drop the rest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.contract import Contract

# Text that stands for a missing value, and the fill text.
MISSING_MARKERS = ("unknown", "NA", "NAN", "NULL")
FILL_TEXT = "unknown"


def markers_to_null(
    df: DataFrame,
    markers: Sequence[str] = MISSING_MARKERS,
    *,
    trim: bool = False,
    ignore_case: bool = False,
) -> DataFrame:
    """Turn marker texts into NULL; exact match unless asked otherwise."""
    wanted = [m.lower() for m in markers] if ignore_case else list(markers)

    def cleaned(name: str):
        probe = F.col(name)
        if trim:
            probe = F.trim(probe)
        if ignore_case:
            probe = F.lower(probe)
        return F.when(~probe.isin(wanted), F.col(name)).alias(name)

    return df.select(
        *(
            cleaned(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def fill_missing(
    df: DataFrame,
    columns: Sequence[str],
    text: str = FILL_TEXT,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Fill text columns with ``text``; others only where a default is given."""
    defaults = dict(defaults or {})
    values = {
        f.name: defaults.get(f.name, text)
        for f in df.schema.fields
        if f.name in columns and (f.name in defaults or isinstance(f.dataType, T.StringType))
    }
    return df.na.fill(values) if values else df


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any of the columns."""
    present = [c for c in columns if c in df.columns]
    return df.na.drop(subset=present) if present else df


def cleanse_nulls(
    df: DataFrame,
    contract: Contract,
    table: str,
    markers: Sequence[str] = MISSING_MARKERS,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    cleaned = markers_to_null(df, markers)
    filled = fill_missing(cleaned, contract.fillable(table), defaults=defaults)
    return drop_missing(filled, contract.required(table))
