"""Fact rows from cleaned source rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstar.functions.calendar import date_key, week_start

EVENT_COLUMNS = [
    "event_date", "related_article_count", "source_count", "category", "title", "region_id",
    "entity_id",
]


def interest_rows(df: DataFrame, source_id: Column, region_id: Column | None = None) -> DataFrame:
    """The fact shape from rows that carry ``date, entity_id, interest_score``."""
    return df.select(
        date_key(F.col("date")).alias("date_id"),
        "entity_id",
        (F.lit(None).cast("int") if region_id is None else region_id).alias("region_id"),
        source_id.alias("source_id"),
        F.col("interest_score").cast("double").alias("interest_score"),
    )


def weekly_totals(daily: DataFrame, day: str, amount: str) -> DataFrame:
    """Daily amounts summed per entity and week."""
    return daily.groupBy("entity_id", week_start(F.col(day)).alias("date")).agg(
        F.sum(amount).alias("weekly_total")
    )


def own_peak_index(weekly: DataFrame) -> DataFrame:
    """Weekly totals as percent of the entity's own best week; comparable within an
    entity only. Weekly rows are already few per entity, so the window is too."""
    peak = F.max("weekly_total").over(Window.partitionBy("entity_id"))
    return weekly.withColumn(
        "interest_score",
        F.when(peak > 0, F.col("weekly_total") / peak * 100.0).otherwise(F.lit(0.0)),
    )


def in_window(df: DataFrame, column: str, first, last) -> DataFrame:
    """Rows whose week lies in the closed range, or is missing, which the checks report.
    Publications are floored to the week before this filter; news rows are checked instead
    of filtered."""
    week = F.col(column)
    return df.where(week.isNull() | week.between(F.lit(first), F.lit(last)))


def event_rollup(articles: DataFrame) -> DataFrame:
    """One row per entity, week, region and category: how many articles, from how many
    publishers, and the title of the most relevant one that has a title.

    Wants ``entity_id, week, region_id, category, publisher, title, pos``, where a
    smaller ``pos`` is more relevant. Among equal positions, as where two files name one
    entity, the title that sorts first is taken.
    """
    titled = F.when(F.col("title").isNotNull(), F.struct("pos", "title"))
    grouped = articles.groupBy("entity_id", F.col("week").alias("event_date"), "region_id",
                               "category").agg(
        F.count(F.lit(1)).alias("related_article_count"),
        F.count_distinct("publisher").alias("source_count"),
        F.min_by("title", titled).alias("title"),
    )
    return grouped.select(*EVENT_COLUMNS)
