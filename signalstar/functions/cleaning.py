"""Raw text to typed values. Text that cannot be read becomes NULL, which the
quality checks then count; nothing is guessed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalstar.functions.calendar import week_start

# What the sources print for "some, but below one", and the first day
# of each regional snapshot window.
BELOW_ONE = "<1"
BELOW_ONE_SCORE = 0.5
SNAPSHOT_DAYS = {"baseline": date(2023, 1, 1), "current": date(2026, 5, 15)}

# The layouts of the source time stamps.
NEWS_STAMP = "yyyyMMdd'T'HHmmss'Z'"
PUBLICATION_STAMP = "yyyy/MM/dd HH:mm"
PAGEVIEW_DAY = "yyyyMMdd"


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def national_score(text: Column) -> Column:
    """A weekly score cell. Only the whole cell ``<1`` stands for a half; a blank
    cell is missing and stays NULL."""
    cell = F.trim(text)
    return F.when(cell == BELOW_ONE, F.lit(BELOW_ONE_SCORE)).otherwise(
        nan_to_null(cell.try_cast("double"))
    )


def percent_score(text: Column) -> Column:
    """A regional percent cell. Blank means too little data and counts as zero;
    anything that begins with ``<1`` (``<1%``, ``<10%``) counts as a half."""
    cell = F.trim(F.coalesce(text, F.lit("")))
    number = F.regexp_replace(cell, "%+$", "")
    return (
        F.when((cell == "") | (F.lower(cell) == "nan"), F.lit(0.0))
        .when(cell.startswith(BELOW_ONE), F.lit(BELOW_ONE_SCORE))
        .otherwise(number.try_cast("double"))
    )


def snapshot_week(window: Column, days: dict[str, date] | None = None) -> Column:
    """The week that stands for a whole snapshot window."""
    pairs = list((days or SNAPSHOT_DAYS).items())
    picked = F.when(window == pairs[0][0], F.lit(pairs[0][1]))
    for name, day in pairs[1:]:
        picked = picked.when(window == name, F.lit(day))
    return week_start(picked)


def stamp_week(stamp: Column, layout: str) -> Column:
    """The week of a time stamp in the given layout."""
    return week_start(F.to_date(F.try_to_timestamp(stamp, F.lit(layout))))


def pageview_day(stamp: Column) -> Column:
    """``2023010100`` holds the day in its first eight characters."""
    return F.to_date(F.try_to_timestamp(F.substring(stamp, 1, 8), F.lit(PAGEVIEW_DAY)))


def latest_year(by_year: Column) -> Column:
    """The newest key of a year-to-value map, compared as numbers (so 999 < 2023)."""
    ranked = F.transform(
        F.map_keys(by_year), lambda k: F.struct(k.cast("int").alias("n"), k.alias("year"))
    )
    return F.array_max(ranked).getField("year")


def sentence_case(text: Column) -> Column:
    """First letter upper, the rest untouched (``initcap`` would lower it)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))
