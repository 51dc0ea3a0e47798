"""Do independent sources agree?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.functions.calendar import date_key, key_to_date, week_start
from signalstar.functions.measures import pair_correlation, rounded
from signalstar.operators.growth import WINDOW_DAYS
from signalstar.plans.star import Star
from signalstar.sources.tables import materialised


def weekly_by_source(star: Star, first: str, second: str) -> DataFrame:
    """Mean score of two sources for every entity and week that has any row."""
    named = star.name_sources(star.interest, many=True)
    score, source = F.col("interest_score"), F.col("source_name")
    return named.groupBy("entity_id", "date_id").agg(
        F.avg(F.when(source == first, score)).alias("first_score"),
        F.avg(F.when(source == second, score)).alias("second_score"),
    )


def side_by_side(star: Star, first: str, second: str) -> DataFrame:
    return star.name_entities(weekly_by_source(star, first, second)).select(
        key_to_date(F.col("date_id")).alias("date"),
        "entity_name",
        rounded(F.col("first_score")).alias("first_score"),
        rounded(F.col("second_score")).alias("second_score"),
    ).orderBy("entity_name", "date")


def source_pivot(star: Star, names: list[str]) -> DataFrame:
    """Weekly mean with one column per listed source (listed, so that no job is
    needed to find the columns)."""
    weekly = (
        star.name_sources(star.interest, many=True)
        .groupBy("date_id", "entity_id")
        .pivot("source_name", names)
        .agg(F.avg("interest_score"))
    )
    return star.name_entities(weekly).select(
        key_to_date(F.col("date_id")).alias("date"),
        "entity_name",
        *[rounded(F.col(f"`{n}`")).alias(n) for n in names],
    )


def correlations(star: Star, first: str, second: str) -> DataFrame:
    """Correlation of the two weekly series per entity. ``n_weeks`` counts all weeks
    and ``n_pairs`` those with both sources."""
    weekly = weekly_by_source(star, first, second)
    both = F.col("first_score").isNotNull() & F.col("second_score").isNotNull()
    per_entity = weekly.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_weeks"),
        F.count_if(both).alias("n_pairs"),
        pair_correlation(F.col("first_score"), F.col("second_score")).alias("r"),
    )
    return star.name_entities(per_entity).select(
        "entity_name", "n_weeks", "n_pairs", rounded(F.col("r"), 3).alias("correlation")
    ).orderBy(F.desc_nulls_last("correlation"), "entity_name")


def source_agreement(
    star: Star,
    days: int = WINDOW_DAYS,
    event_days: int | None = None,
    required: int = 3,
) -> DataFrame:
    """How many sources show a rise per entity, and whether that is enough.

    An interest source rises when its mean does between its own first and last
    windows; an event category when its count does.
    """
    event_days = days if event_days is None else event_days
    interest = star.interest.select(
        "entity_id",
        F.concat(F.lit("interest:"), F.col("source_id").cast("string")).alias("signal"),
        "date_id",
        F.col("interest_score").alias("score"),
        F.lit(days).alias("days"),
    )
    events = star.events.select(
        "entity_id",
        F.concat(F.lit("events:"), F.col("category")).alias("signal"),
        date_key(week_start(F.col("event_date"))).alias("date_id"),
        F.lit(None).cast("double").alias("score"),
        F.lit(event_days).alias("days"),
    )
    # One row per entity, signal and week, written once: the bounds of a signal and its
    # levels come from these cells instead of from the facts again.
    cells = materialised(
        interest.unionByName(events)
        .groupBy("signal", "days", "entity_id", "date_id")
        .agg(
            F.sum("score").alias("total"),
            F.count("score").alias("scored"),
            F.count(F.lit(1)).alias("n"),
        ),
        "cells",
    )
    bounds = cells.groupBy("signal").agg(
        F.min("date_id").alias("first"), F.max("date_id").alias("last")
    )
    first_out = date_key(F.date_add(key_to_date(F.col("first")), F.col("days")))
    last_out = date_key(F.date_sub(key_to_date(F.col("last")), F.col("days")))
    in_first = F.col("date_id") < first_out
    in_last = ~in_first & (F.col("date_id") > last_out)

    def level(inside):
        mean = F.sum(F.when(inside, F.col("total"))) / F.nullif(
            F.sum(F.when(inside, F.col("scored"))), F.lit(0)
        )
        count = F.sum(F.when(inside, F.col("n")).otherwise(F.lit(0))).cast("double")
        return F.when(F.col("signal").startswith("interest:"), mean).otherwise(count)

    levels = (
        cells.join(bounds, "signal")
        .groupBy("entity_id", "signal")
        .agg(level(in_first).alias("before"), level(in_last).alias("after"))
    )
    rises = F.col("after") > F.col("before")
    per_entity = levels.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.count_if(rises).alias("n_rising"),
        (F.count_if(rises) >= required).alias("corroborated"),
    )
    return star.name_entities(per_entity).select(
        "entity_name", "n_sources", "n_rising", "corroborated"
    ).orderBy(F.desc("n_rising"), "entity_name")
