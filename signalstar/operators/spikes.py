"""Peaks against the expected level of the same entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalstar.functions.calendar import key_to_date
from signalstar.functions.measures import growth_pct, rounded
from signalstar.plans.star import Star


def weekly_cells(rows: DataFrame) -> DataFrame:
    """Per entity and week: peak, sum and count. After this step an entity has no more
    rows than there are weeks, however many facts it had."""
    return rows.groupBy("entity_id", "date_id").agg(
        F.max("interest_score").alias("peak"),
        F.sum("interest_score").alias("total"),
        F.count("interest_score").alias("n"),
    )


def largest_spikes(star: Star, source: str) -> DataFrame:
    """KPI 9.5: the highest score of each entity against its mean. Among equal peaks
    the latest week is reported."""
    peaks = (
        weekly_cells(star.interest_of(source))
        .groupBy("entity_id")
        .agg(
            F.max(F.struct("peak", "date_id")).alias("top"),
            (F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("expected"),
        )
    )
    return star.name_entities(peaks).select(
        "entity_name",
        key_to_date(F.col("top.date_id")).alias("peak_date"),
        F.col("top.peak").alias("peak_interest"),
        rounded(F.col("expected")).alias("expected_interest"),
        rounded(growth_pct(F.col("top.peak"), F.col("expected"))).alias("spike_pct"),
    ).orderBy(F.desc_nulls_last("spike_pct"), "entity_name")


def peak_ranks(star: Star, source: str, max_rank: int = 1) -> DataFrame:
    """Weeks ranked by peak within their entity; weeks that tie share a rank, so an
    entity may show several weeks at rank one."""
    by_peak = Window.partitionBy("entity_id").orderBy(F.desc("peak"))
    entity = Window.partitionBy("entity_id")
    ranked = weekly_cells(star.interest_of(source)).select(
        "entity_id",
        "date_id",
        "peak",
        F.rank().over(by_peak).alias("peak_rank"),
        (F.sum("total").over(entity) / F.nullif(F.sum("n").over(entity), F.lit(0))).alias(
            "expected"
        ),
    )
    return star.name_entities(ranked.where(F.col("peak_rank") <= max_rank)).select(
        "entity_name",
        key_to_date(F.col("date_id")).alias("date"),
        F.col("peak").alias("peak_interest"),
        rounded(F.col("expected")).alias("expected_interest"),
        rounded(growth_pct(F.col("peak"), F.col("expected"))).alias("spike_pct"),
        "peak_rank",
    ).orderBy(F.desc_nulls_last("spike_pct"), "entity_name", "date")
