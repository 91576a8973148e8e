"""Left joins that stay balanced when one key holds a large part of the rows.

Three ways, chosen by the size of the inputs:

* a lookup table is small enough for the session's broadcast limit: broadcast it;
* the side with repeated keys is too small to hold a troublesome key: plain join;
* otherwise shuffle, with the rows of hot keys spread over salted partitions
  and their partner rows repeated once per salt.

Hot is a key with ``min_hot_rows`` rows and at least 1/MAX_HOT_KEYS of all rows, so
there are at most MAX_HOT_KEYS of them, which bounds what is broadcast to mark
them. A key gets as many salts as its rows fill tasks of ``min_hot_rows``. Salts only
route rows: whichever keys are marked, the result is the plain join.

Hot keys are found without a shuffle of all keys. Each task counts its rows in HOT_CELLS cells by
the hash of their key, and the cells are added up; a hot key makes its cell hot. Keys are counted, in the
map tasks first, only among the rows of hot cells: these are hot keys and the one in ten thousand or so
that share a cell with one, since a cell holds a tenth of a hot key's least rows on average.

A salt is a hash of the row, not a random number: a task that is run again
after the loss of an executor sends every row where it went the first time. Rows that
are equal in all columns share a salt, so keep a row's identity until after the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.sizing import fits_broadcast, input_bytes

MAX_HOT_KEYS = 100_000
#: Counters of rows by key hash; ten times the greatest number of hot keys.
HOT_CELLS = 1 << 20
#: Rows without a key have no partner, so spreading them widely costs nothing.
NULL_SALTS = 1 << 16

_HOT, _SALT, _HIT, _CELL = "__hot", "__salt", "__hit", "__cell"


@dataclass(frozen=True)
class Skew:
    """From what size on keys are counted, and how hot ones are spread.

    ``salts`` is the least number of salts of a hot key. A table dominated by one key is
    the one that compresses best, hence the low ``min_bytes``.
    """

    min_bytes: int = 64 << 20
    min_hot_rows: int = 1_000_000
    salts: int = 8


DEFAULT_SKEW = Skew()


def count_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; combined in the map tasks, so a hot key is no burden."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def find_hot_keys(
    df: DataFrame, keys: Sequence[str], skew: Skew = DEFAULT_SKEW, cells: int = HOT_CELLS
) -> DataFrame:
    """The hot keys of *df* and the number of salts of each, by way of the cells of their hashes."""
    keyed = df.filter(~_any_null(keys)).select(*keys)
    marked = keyed.withColumn(_CELL, F.pmod(F.xxhash64(*keys), F.lit(cells)).cast("int"))
    counts = marked.groupBy(_CELL).agg(F.count(F.lit(1)).alias("rows"))
    # counted on the keys: a subquery shares no shuffle with the plan around it
    total = keyed.agg(F.count(F.lit(1)).alias("total")).scalar()
    # at most MAX_HOT_KEYS cells
    hot = F.broadcast(counts.filter(_is_hot(total, skew)).select(_CELL))
    few = marked.join(hot, _CELL, "left_semi")
    return hot_keys(count_keys(few, keys), keys, skew, total)


def _is_hot(total: Column, skew: Skew) -> Column:
    return (F.col("rows") >= skew.min_hot_rows) & (F.col("rows") >= total / F.lit(MAX_HOT_KEYS))


def hot_keys(
    counts: DataFrame, keys: Sequence[str], skew: Skew = DEFAULT_SKEW, total: Column | None = None
) -> DataFrame:
    """The hot keys of a table with ``rows`` per key, and the number of salts of each.

    ``total`` are all rows, where the table does not list all keys.
    """
    if total is None:
        total = counts.agg(F.sum("rows").alias("total")).scalar()
    hot = _is_hot(total, skew)
    salts = F.greatest(F.lit(skew.salts), F.ceil(F.col("rows") / F.lit(skew.min_hot_rows)))
    return counts.filter(hot & ~_any_null(keys)).select(*keys, salts.cast("int").alias(_HOT))


def lookup_join(
    many: DataFrame,
    one: DataFrame,
    on: str | Sequence[str],
    *,
    counts: DataFrame | None = None,
    base: DataFrame | None = None,
    size: int | None = None,
    skew: Skew = DEFAULT_SKEW,
    how: str = "left",
) -> DataFrame:
    """``many`` left or inner join ``one``, for keys that repeat in ``many``.

    ``base`` is that base, where its keys have not been counted for another purpose.
    ``size`` is the measured size of ``one`` where it is known; else that of its inputs decides.

    ``counts`` (key, rows) gives the weight of the keys where ``many`` is itself a
    chain of joins that would have to run for it; it may come from the chain's base.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(one, size):
        return many.join(F.broadcast(one), keys, how)
    if input_bytes(many) < skew.min_bytes:
        return many.join(one, keys, how)
    if counts is None:
        hot = find_hot_keys(many if base is None else base, keys, skew)
    else:
        hot = hot_keys(counts, keys, skew)
    left = _salt_rows(many, keys, hot)
    right = _repeat_rows(one, keys, hot).drop(_HOT)
    return left.join(right, [*keys, _SALT], how).drop(_SALT)


def expand_join(
    one: DataFrame,
    many: DataFrame,
    on: str | Sequence[str],
    *,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """``one`` left join ``many``, for keys that repeat in ``many``.

    A hot key has rows in ``many`` by definition, so a copy of its row in ``one``
    that found no partner under its salt is an artefact and is filtered out.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if input_bytes(many) < skew.min_bytes:
        return one.join(many, keys, "left")
    keyed = many.filter(~_any_null(keys))
    hot = find_hot_keys(keyed, keys, skew)
    left = _repeat_rows(one, keys, hot)
    right = _salt_rows(keyed, keys, hot).withColumn(_HIT, F.lit(True))
    joined = left.join(right, [*keys, _SALT], "left")
    return joined.filter(F.col(_HOT).isNull() | F.col(_HIT).isNotNull()).drop(_HOT, _HIT, _SALT)


def _any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | F.col(key).isNull()
    return found


def _mark(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    # at most MAX_HOT_KEYS rows
    return df.join(F.broadcast(hot), list(keys), "left")


def _row_salt(df: DataFrame) -> Column:
    salts = F.coalesce(F.col(_HOT), F.lit(NULL_SALTS))
    return F.pmod(F.xxhash64(*df.columns), salts).cast("int")


def _salt_rows(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """One salt per row; rows without a key are spread like those of a hot key."""
    spread = F.col(_HOT).isNotNull() | _any_null(keys)
    salt = F.when(spread, _row_salt(df)).otherwise(F.lit(0))
    return _mark(df, keys, hot).withColumn(_SALT, salt).drop(_HOT)


def _repeat_rows(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """A copy per salt for rows of hot keys, one row for all others."""
    copies = (
        F.when(F.col(_HOT).isNotNull(), F.sequence(F.lit(0), F.col(_HOT) - 1))
        .when(_any_null(keys), F.array(_row_salt(df)))
        .otherwise(F.array(F.lit(0)))
    )
    return _mark(df, keys, hot).withColumn(_SALT, F.explode(copies))
