"""Weeks that run Sunday to Saturday, integer date keys and calendar tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The closed project window.
WINDOW_START = date(2023, 1, 1)
WINDOW_END = date(2026, 12, 31)


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day`` (``date_trunc('week')`` would give Monday)."""
    return F.date_sub(F.next_day(day, "SUN"), 7)


def date_key(day: Column) -> Column:
    """A date as a yyyymmdd integer; the key orders exactly as the date does."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_to_date(key: Column) -> Column:
    """The inverse of :func:`date_key`, by arithmetic so that no text is parsed."""
    return F.make_date(
        (key / 10000).cast("int"), (key % 10000 / 100).cast("int"), (key % 100).cast("int")
    )


def key_year(key: Column) -> Column:
    return (key / 10000).cast("int")


def quarter_label(day: Column) -> Column:
    """``Q3 2026``: a quarter number alone would merge the years."""
    return F.concat(F.lit("Q"), F.quarter(day), F.lit(" "), F.year(day))


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def with_calendar_columns(weeks: DataFrame, day: str = "date") -> DataFrame:
    """Key, month, quarter and year for a frame that holds one row per week."""
    d = F.col(day)
    return weeks.select(
        date_key(d).alias("date_id"),
        d.alias("date"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    )


def weeks_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One calendar row per week from the week of ``first`` up to ``last``.

    ``bounds`` is a one-row frame, which may be computed from data.
    """
    weeks = bounds.select(
        F.explode(
            F.sequence(week_start(F.col(first)), F.col(last), F.expr("INTERVAL 7 DAYS"))
        ).alias("date")
    )
    return with_calendar_columns(weeks)


def calendar(
    spark: SparkSession, start: date = WINDOW_START, end: date = WINDOW_END
) -> DataFrame:
    """The weekly calendar of a fixed window."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return weeks_between(bounds, "first", "last")
