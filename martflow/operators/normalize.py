"""Normalisation of contact columns (e-mail, phone, postal code).

A column's kind is read from its name. Each kind has the characters it keeps,
a pattern that a clean value must match, and thus its own set of rejects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns of valid contact values, and the characters that plain
# normalisation strips.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^\d{3}[-.]?\d{3}[-.]?\d{4}$"
ZIP_PATTERN = r"^\d{5}(-\d{4})?$"
SPECIAL_CHARACTERS = r"[^\w\s]"


@dataclass(frozen=True)
class ContactKind:
    name: str
    strip: str
    pattern: str


KINDS = (
    ContactKind("email", r"[^\w@.%+-]", EMAIL_PATTERN),
    ContactKind("phone", r"[^0-9]", PHONE_PATTERN),
    ContactKind("zip", r"[^0-9-]", ZIP_PATTERN),
)
MODES = ("drop", "null", "flag")


def strip_specials(value: Column) -> Column:
    """Without special characters, in lower case, without outer spaces."""
    return F.trim(F.lower(F.regexp_replace(value, SPECIAL_CHARACTERS, "")))


def kind_of(column: str) -> ContactKind | None:
    return next((k for k in KINDS if k.name in column.lower()), None)


def contact_columns(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, ContactKind]:
    """The text columns of a known kind, among ``columns`` if given."""
    found = {}
    for field in df.schema.fields:
        kind = kind_of(field.name)
        wanted = columns is None or field.name in columns
        if kind and wanted and isinstance(field.dataType, T.StringType):
            found[field.name] = kind
    return found


def clean_contact(value: Column, kind: ContactKind) -> Column:
    return F.lower(F.regexp_replace(value, kind.strip, ""))


def is_valid_contact(value: Column, kind: ContactKind) -> Column:
    """On cleaned values; a missing value is not valid."""
    return F.coalesce(value.rlike(kind.pattern), F.lit(False))


def normalize_contacts(
    df: DataFrame, columns: Sequence[str] | None = None, mode: str = "drop"
) -> DataFrame:
    """Clean all contact columns at once.

    ``drop`` removes rows with a value that is not valid, ``null`` blanks the
    value, ``flag`` keeps everything and adds ``<column>_valid``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
    kinds = contact_columns(df, columns)
    if not kinds:
        return df
    cleaned = df.withColumns({c: clean_contact(F.col(c), k) for c, k in kinds.items()})
    valid = {c: is_valid_contact(F.col(c), k) for c, k in kinds.items()}
    if mode == "flag":
        return cleaned.withColumns({f"{c}_valid": ok for c, ok in valid.items()})
    if mode == "null":
        return cleaned.withColumns({c: F.when(ok, F.col(c)) for c, ok in valid.items()})
    for ok in valid.values():
        cleaned = cleaned.filter(ok)
    return cleaned


def contact_rejects(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per contact column: rows, valid rows, rejected rows and missing values."""
    kinds = contact_columns(df, columns)
    entries = []
    for name, kind in kinds.items():
        ok = is_valid_contact(clean_contact(F.col(name), kind), kind)
        entries.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit(kind.name).alias("kind"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(ok).alias("valid"),
                F.count_if(~ok & F.col(name).isNotNull()).alias("rejected"),
                F.count_if(F.col(name).isNull()).alias("missing"),
            )
        )
    if not entries:
        raise ValueError(f"table {table!r} has no contact columns")
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def normalize_tables(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]], mode: str = "drop"
) -> dict[str, DataFrame]:
    """Normalise the contract's contact columns in every table."""
    return {
        name: normalize_contacts(df, columns.get(name, ()), mode) for name, df in tables.items()
    }
