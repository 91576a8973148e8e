"""Generated lookup tables: the calendar and the order statuses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The default calendar and the order statuses.
FIRST_DAY = dt.date(2016, 1, 1)
LAST_DAY = dt.date(2019, 12, 31)
STATUSES = ((1, "Pending"), (2, "Processing"), (3, "Rejected"), (4, "Completed"))


@dataclass(frozen=True)
class Calendar:
    """A range of days, whose ids count from 1 on the first day.

    An id follows from its day alone and the other way round, so facts get their ids, and the
    mart its days, by a column expression: no join, whatever the length of the calendar. A stray
    day such as 9999-12-31 has no id and adds no rows. A calendar that ends later keeps all ids.
    """

    first: dt.date = FIRST_DAY
    last: dt.date = LAST_DAY

    def __post_init__(self):
        if self.first > self.last:
            raise ValueError(f"the calendar ends on {self.last}, before its first day {self.first}")

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1

    def date_id(self, day: Column) -> Column:
        """The id of a day; NULL outside the calendar."""
        day = day.cast("date")
        return F.when(day.between(F.lit(self.first), F.lit(self.last)), F.datediff(day, F.lit(self.first)) + 1)

    def date(self, date_id: Column) -> Column:
        """The day of an id; NULL for ids that the calendar lacks."""
        return F.when(date_id.between(1, self.days), F.date_add(F.lit(self.first), (date_id - 1).cast("int")))

    def table(self, spark: SparkSession) -> DataFrame:
        return date_lookup(spark, self.first, self.last)


def calendar_of(dates: DataFrame) -> Calendar:
    """The calendar behind a stored table of ``date`` and ``date_id``, whose ids are checked (one row)."""
    before = F.date_sub("date", F.col("date_id").cast("int"))
    found = dates.agg(
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.min(before).alias("least"),
        F.max(before).alias("most"),
        F.count(before).alias("days"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("date_id").alias("ids"),
    ).first()
    if not found["rows"]:
        raise ValueError("the table of dates is empty")
    calendar = Calendar(found["first"], found["last"])
    start = calendar.first - dt.timedelta(days=1)
    counted = {found["days"], found["rows"], found["ids"], calendar.days}
    if {found["least"], found["most"]} != {start} or len(counted) != 1:
        raise ValueError("the ids of the dates do not count the days from the first one")
    return calendar


def date_lookup(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """One row per day with a 1-based ``date_id``."""
    span = spark.range(0, 1, 1, numPartitions=1)
    return _days(span.select(F.lit(first).alias("first"), F.lit(last).alias("last")))


def date_lookup_for(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The calendar from the least to the greatest day found in the columns."""
    days = [F.col(c).cast("date") for c in columns]
    first, last = (days[0], days[0]) if len(days) == 1 else (F.least(*days), F.greatest(*days))
    return _days(df.agg(F.min(first).alias("first"), F.max(last).alias("last")))


def _days(span: DataFrame) -> DataFrame:
    # The id is the distance from the first day: a numbering window would bring
    # the calendar to one task for the same result.
    day = F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    return span.select("first", day).select(
        "date", (F.datediff("date", "first") + 1).cast("int").alias("date_id")
    )


def status_lookup(spark: SparkSession) -> DataFrame:
    # Inline rows have a known size, so joins see that this table is tiny.
    rows = ", ".join(f"({number}, '{name}')" for number, name in STATUSES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS statuses(status_id, status)")
