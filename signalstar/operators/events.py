"""Event counts, attention and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.functions.calendar import quarter_end, quarter_label
from signalstar.operators.ranking import top_ranked
from signalstar.operators.sizing import join_measured, measured
from signalstar.plans.star import Star
from signalstar.sources.tables import materialised


def by_category(star: Star) -> DataFrame:
    return star.events.groupBy("category").agg(F.count(F.lit(1)).alias("n_events")).orderBy(
        F.desc("n_events"), "category"
    )


def by_quarter(star: Star) -> DataFrame:
    day = F.col("event_date")
    return (
        star.events.groupBy(
            F.year(day).alias("year"), F.quarter(day).alias("quarter"), "category"
        )
        .agg(F.count(F.lit(1)).alias("n_events"))
        .orderBy("year", "quarter", "category")
    )


def by_quarter_label(star: Star) -> DataFrame:
    day = F.col("event_date")
    return star.events.groupBy(quarter_label(day).alias("year_quarter"), "category").agg(
        F.count(F.lit(1)).alias("n_events")
    )


def quarter_pivot(star: Star, categories: list[str] | None = None) -> DataFrame:
    """Quarter ends by category, NULL where it has no events. The columns are the
    categories present, or those listed."""
    counts = star.events.groupBy(
        quarter_end(F.col("event_date")).alias("quarter_end"), "category"
    ).agg(F.count(F.lit(1)).alias("n"))
    counts, _ = measured(counts)
    return counts.groupBy("quarter_end").pivot("category", categories).agg(F.sum("n"))


def by_entity(star: Star) -> DataFrame:
    counts = star.events.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_events"))
    return star.name_entities(counts).select("entity_name", "n_events").orderBy(
        F.desc("n_events"), "entity_name"
    )


def on_calendar(star: Star) -> DataFrame:
    """Events per calendar week, joined by date since events carry no date key."""
    weekly = star.events.groupBy(F.col("event_date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum("related_article_count").alias("n_articles"),
    )
    return star.dates.join(weekly, "date").select(
        "date_id", "date", "quarter", "year", "n_events", "n_articles"
    )


def high_attention(star: Star, prob: float = 0.9) -> DataFrame:
    """Events at or above their category's percentile of articles or of publishers."""
    # Limits and result both read the rollup, which is computed once.
    events = materialised(star.events, "rollup")
    # Only distinct counts are held, and counts that add up to the articles are few.
    limits = events.groupBy("category").agg(
        F.percentile("related_article_count", prob).alias("article_limit"),
        F.percentile("source_count", prob).alias("source_limit"),
    )
    loud = join_measured(events, limits, "category").where(
        (F.col("related_article_count") >= F.col("article_limit"))
        | (F.col("source_count") >= F.col("source_limit"))
    )
    return star.name_entities(loud, many=True).select(
        "event_date", "entity_name", "category", "title", "related_article_count",
        "source_count",
    ).orderBy(
        F.desc("related_article_count"), F.desc("source_count"), "event_date", "entity_name",
        "category",
    )


def most_reported(star: Star, top: int = 15) -> DataFrame:
    """Events ranked by article count over all events, ties at the cut included."""
    ranked = top_ranked(star.events, "related_article_count", top)
    return star.name_entities(ranked).select(
        "event_date", "entity_name", "category", "title", "related_article_count",
        "source_count", "rank",
    ).orderBy("rank", "event_date", "entity_name", "category")
