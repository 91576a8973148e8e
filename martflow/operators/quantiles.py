"""Exact discrete quantiles without bringing a column to one task.

Spark's exact percentile aggregates keep a map of all distinct values in a
single reducer. Here the first scan takes a mergeable sketch of the values, whose ranks are known
within a bound, and so brackets each wanted rank by two values close to it. The second scan
counts the rows below and inside the brackets exactly. The third lists the values of a
bracket with their rows, if it has at most ``VALUES`` rows. Larger brackets are first
narrowed by counting equal-width bins, a scan each; a bracket that misses its rank is
replaced by the whole range. What a scan ships is a sketch, or a row per bin or value and task.
Run it on a table that is stored, not on a long lineage.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The sketch's ranks are off by less than one in so many rows.
ACCURACY = 10_000
#: Rows of a bracket whose values are listed.
VALUES = 50_000


@dataclass(frozen=True)
class _Interval:
    low: float
    high: float
    below: int  # rows smaller than ``low``
    rows: int  # rows inside; -1 for those that are not counted yet

    def holds(self, x: Column) -> Column:
        return x.between(self.low, self.high)

    def bin(self, x: Column, bins: int) -> Column:
        scale = 1.0 if math.isfinite(self.high - self.low) else 0.5
        width = self.high * scale - self.low * scale
        share = (x * scale - self.low * scale) / width
        return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    bins: int = 1024,
    accuracy: int = ACCURACY,
    most_values: int = VALUES,
) -> list[float]:
    """The smallest values whose share of rows at or below reaches each probability.

    NULL and NaN do not count. Infinities do, as the least and greatest values: they are
    ranked apart, so that brackets are finite. The list is empty when there are no values.
    """
    if any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities must lie between 0 and 1")
    x = F.col("x")
    values = df.select(F.col(column).cast("double").alias("x")).filter(
        x.isNotNull() & ~F.isnan(x)
    )
    finite = F.abs(x) < float("inf")
    number = F.when(finite, x)
    places = [min(1.0, max(0.0, p + side)) for p in probabilities for side in _sides(accuracy)]
    total, least, low, high, inner, sketch = values.agg(
        F.count(x),
        F.count_if(x == float("-inf")),
        F.min(number),
        F.max(number),
        F.count(number),
        F.approx_percentile(x, places, accuracy) if places else F.lit(None),
    ).first()
    if total == 0:
        return []
    ranks = [max(1, math.ceil(Fraction(str(p)) * total)) for p in probabilities]
    values = values.filter(finite)
    found = []
    for number, rank in enumerate(ranks):
        if rank <= least:
            found.append(_Interval(-math.inf, -math.inf, 0, 0))
        elif rank > least + inner:
            found.append(_Interval(math.inf, math.inf, 0, 0))
        else:
            near = (min(max(s, low), high) for s in sketch[2 * number : 2 * number + 2])
            found.append(_Interval(*near, -1, -1))
    found = _counted(values, found, ranks, _Interval(low, high, least, inner), least)
    while True:
        pending = list(dict.fromkeys(i for i in found if i.low < i.high))
        if not pending:
            return [i.low for i in found]
        slot, bin_ = F.lit(None).cast("int"), F.lit(None).cast("double")
        kept = F.lit(False)
        for number, interval in enumerate(pending):
            inside = interval.holds(x)
            # a list of all values, or bins
            own = x if interval.rows <= most_values else interval.bin(x, bins).cast("double")
            slot = F.when(inside, number).otherwise(slot)
            bin_ = F.when(inside, own).otherwise(bin_)
            kept = kept | inside
        counted = (
            values.filter(kept)
            .groupBy(slot.alias("slot"), bin_.alias("bin"))
            .agg(F.count(x).alias("rows"), F.min(x).alias("low"), F.max(x).alias("high"))
            .collect()
        )
        parts = sorted(counted, key=lambda row: (row["slot"], row["bin"]))
        before = found
        found = [
            _narrow(interval, rank, [p for p in parts if pending[p["slot"]] == interval])
            for interval, rank in zip(found, ranks)
        ]
        if found == before:
            raise RuntimeError(f"no bin of {column} holds the wanted rank")


def _sides(accuracy: int) -> tuple[float, float]:
    """How far below and above a place the sketch is asked, its own ranks being off by 1/accuracy."""
    return -2.0 / accuracy, 2.0 / accuracy


def _counted(
    values: DataFrame, found: list[_Interval], ranks: list[int], whole: _Interval, least: int
) -> list[_Interval]:
    """The brackets with the rows below and inside them; the whole range for one that misses its rank.

    Brackets that meet would give a row two slots; they are joined into one.
    """
    open_ = sorted({(i.low, i.high) for i in found if i.rows < 0})
    joined: list[tuple[float, float]] = []
    for low, high in open_:
        if joined and low <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    if not joined:
        return found
    x = F.col("x")
    counts = values.agg(
        *[F.count_if(x < low) for low, _ in joined], *[F.count_if(x.between(*b)) for b in joined]
    ).first()
    exact = [
        _Interval(low, high, least + counts[n], counts[len(joined) + n])
        for n, (low, high) in enumerate(joined)
    ]
    out = []
    for interval, rank in zip(found, ranks):
        if interval.rows < 0:
            interval = next(e for e in exact if e.low <= interval.low <= e.high)
            if not interval.below < rank <= interval.below + interval.rows:
                return [i if i.rows == 0 else whole for i in found]
        out.append(interval)
    return out


def _narrow(interval: _Interval, rank: int, parts: list) -> _Interval:
    below = interval.below
    for part in parts:
        if below + part["rows"] >= rank:
            return _Interval(part["low"], part["high"], below, part["rows"])
        below += part["rows"]
    return interval
