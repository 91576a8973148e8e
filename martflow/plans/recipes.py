"""Cleansing recipes: which steps a table goes through, and in which order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from martflow.contract import Contract
from martflow.operators.casting import cast_to_contract, prefix_shared_columns
from martflow.operators.dedupe import dedupe, dedupe_chain
from martflow.operators.normalize import normalize_contacts
from martflow.operators.nulls import cleanse_nulls
from martflow.operators.outliers import Z_THRESHOLD, remove_outliers_chain
from martflow.operators.quality import StepCounts, step_audit, valid_postal_codes
from martflow.sources.lookups import Calendar
from martflow.sources.workdir import store


@dataclass(frozen=True)
class Setting:
    """What the steps need to know besides the rows."""

    contract: Contract
    postal: DataFrame | None = None
    contact_mode: str = "null"
    int_type: str = "int"
    z_threshold: float = Z_THRESHOLD
    calendar: Calendar = Calendar()
    #: rows with an unsound key are set aside in the rejects, or stop the run
    raise_on_bad_keys: bool = False
    store: Callable[[DataFrame], DataFrame] = store


Step = Callable[[DataFrame, str, Setting], DataFrame]


def normalized(df: DataFrame, table: str, setting: Setting) -> DataFrame:
    columns = [r.table_columns for r in setting.contract.table(table)]
    return normalize_contacts(df, columns, setting.contact_mode)


def unique_columns(df: DataFrame, table: str, setting: Setting) -> DataFrame:
    return dedupe_chain(df, setting.contract.unique(table))


def unique_key(df: DataFrame, table: str, setting: Setting) -> DataFrame:
    """One row per primary key, which may consist of several columns."""
    return dedupe(df, [r.table_columns for r in setting.contract.primary_key(table)])


def without_nulls(df: DataFrame, table: str, setting: Setting) -> DataFrame:
    return cleanse_nulls(df, setting.contract, table)


def recast(df: DataFrame, table: str, setting: Setting) -> DataFrame:
    return cast_to_contract(df, setting.contract.table(table), setting.int_type)


def without_outliers(*columns: str) -> Step:
    """Z-score removal in the given order, on a stored table (see the operator)."""

    def step(df: DataFrame, table: str, setting: Setting) -> DataFrame:
        return remove_outliers_chain(setting.store(df), columns, setting.z_threshold)

    return step


def known_postal_code(column: str) -> Step:
    def step(df: DataFrame, table: str, setting: Setting) -> DataFrame:
        if setting.postal is None:
            raise ValueError(f"table {table!r} needs a table of postal codes")
        return valid_postal_codes(df, column, setting.postal)

    return step


@dataclass(frozen=True)
class Recipe:
    table: str
    steps: tuple[tuple[str, Step], ...]

    def states(self, df: DataFrame, setting: Setting) -> list[tuple[str, DataFrame]]:
        """The table before the first and after each step."""
        states = [("input", df)]
        for name, step in self.steps:
            states.append((name, step(states[-1][1], self.table, setting)))
        return states

    def apply(self, df: DataFrame, setting: Setting) -> DataFrame:
        return self.states(df, setting)[-1][1]

    def watched(self, df: DataFrame, setting: Setting, counts: StepCounts) -> DataFrame:
        """``apply``, with the rows after each step noted by the job that runs it."""
        df = counts.watch("input", df)
        for name, step in self.steps:
            df = counts.watch(name, step(df, self.table, setting))
        return df

    def audit(self, df: DataFrame, setting: Setting) -> DataFrame:
        return step_audit(self.table, self.states(df, setting))


_NORMALIZE = ("normalize", normalized)
_UNIQUE = ("unique columns", unique_columns)
_KEY = ("unique key", unique_key)
_NULLS = ("nulls", without_nulls)
_RECAST = ("recast", recast)


def _recipe(table: str, *steps: tuple[str, Step]) -> tuple[str, Recipe]:
    return table, Recipe(table, (_NORMALIZE, *steps, _RECAST))


# The order of steps per table, and the outlier columns in turn.
RECIPES: dict[str, Recipe] = dict(
    [
        _recipe("customers", _UNIQUE, _NULLS),
        _recipe("categories", _UNIQUE, _NULLS),
        _recipe("staffs", _NULLS, _UNIQUE),
        _recipe("orders", _NULLS, _UNIQUE),
        _recipe(
            "order_items",
            _NULLS,
            _UNIQUE,
            _KEY,
            ("outliers", without_outliers("list_price", "quantity", "discount")),
        ),
        _recipe("brands", _UNIQUE, _NULLS),
        _recipe("products", _UNIQUE, _NULLS),
        _recipe("stores", _UNIQUE, _NULLS, ("postal code", known_postal_code("zip_code"))),
    ]
)


def cleanse_tables(
    tables: Mapping[str, DataFrame],
    setting: Setting,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Every table by its recipe; a table without one stays as it is."""
    names = list(tables) if only is None else only
    return {
        name: RECIPES[name].apply(tables[name], setting) if name in RECIPES else tables[name]
        for name in names
    }


def prefix_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: prefix_shared_columns(df, name) for name, df in tables.items()}
