"""Search-trend exports: a two-line preamble, a header, then three positional columns
(week or region, the entity's own score, the shared anchor term)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.functions.calendar import week_start
from signalstar.functions.cleaning import national_score, percent_score, snapshot_week
from signalstar.sources.schemas import TREND_LINE
from signalstar.sources.tables import export_name

# What the lines above the data begin with, and how files are named.
PREAMBLE_PREFIX = "Category:"
HEADER_LABELS = ("Week", "Region")
NATIONAL_FILE = r"^Peptides_(.*)\.csv$"
REGIONAL_FILE = r"^(.*)_(baseline|current)\.csv$"


def read_trend_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All data lines of all files in one scan: ``file_name, label, value``.

    Header texts differ per file, so columns go by position; the anchor column is
    never read out of the parser. An export may be one file or a folder of part files of
    that name. A line without a label stays, and its missing week or
    region is then found by the checks.
    """
    lines = spark.read.schema(TREND_LINE).csv(path).select(
        export_name().alias("file_name"), "label", "value"
    )
    above = F.col("label").startswith(PREAMBLE_PREFIX) | F.col("label").isin(*HEADER_LABELS)
    return lines.where(~F.coalesce(above, F.lit(False)))


def national_rows(lines: DataFrame, file_pattern: str = NATIONAL_FILE) -> DataFrame:
    """``entity_name, date, interest_score`` from weekly lines."""
    return lines.select(
        F.regexp_extract("file_name", file_pattern, 1).alias("entity_name"),
        week_start(F.to_date(F.try_to_timestamp("label"))).alias("date"),
        national_score(F.col("value")).alias("interest_score"),
    )


def regional_rows(
    lines: DataFrame, file_pattern: str = REGIONAL_FILE, window_week: Column | None = None
) -> DataFrame:
    """``entity_name, region_name, window, date, interest_score`` from snapshot lines."""
    window = F.regexp_extract("file_name", file_pattern, 2)
    return lines.select(
        F.regexp_extract("file_name", file_pattern, 1).alias("entity_name"),
        F.col("label").alias("region_name"),
        window.alias("window"),
        (snapshot_week(window) if window_week is None else window_week).alias("date"),
        percent_score(F.col("value")).alias("interest_score"),
    )
