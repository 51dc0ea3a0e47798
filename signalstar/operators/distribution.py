"""Score distributions by source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.functions.calendar import key_to_date
from signalstar.functions.measures import rounded
from signalstar.operators.percentiles import ACCURACY, group_percentiles
from signalstar.plans.star import Star

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def score_range(star: Star) -> DataFrame:
    """Minimum, maximum, mean and sample deviation per source."""
    stats = star.interest.groupBy("source_id").agg(
        F.min("interest_score").alias("min_score"),
        F.max("interest_score").alias("max_score"),
        rounded(F.avg("interest_score")).alias("avg_score"),
        rounded(F.stddev("interest_score")).alias("stddev_score"),
    )
    return star.name_sources(stats).select(
        "source_name", "min_score", "max_score", "avg_score", "stddev_score"
    ).orderBy("source_name")


def score_distribution(
    star: Star, approximate: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """Count, quartiles, mean, extremes and deviation per source."""
    stats = {
        "n": F.count(F.lit(1)),
        "min_score": F.min("interest_score"),
        "mean_score": rounded(F.avg("interest_score")),
        "max_score": F.max("interest_score"),
        "stddev_score": rounded(F.stddev("interest_score")),
    }
    both = group_percentiles(
        star.interest, ["source_id"], "interest_score", QUARTILES, accuracy, approximate, stats
    ).withColumns({q: rounded(F.col(q)) for q in QUARTILES})
    return star.name_sources(both).select(
        "source_name", "n", "min_score", "p25", "median", "mean_score", "p75", "max_score",
        "stddev_score",
    ).orderBy("source_name")


def score_histogram(
    star: Star, low: float = 0.0, high: float = 100.0, buckets: int = 20
) -> DataFrame:
    """Rows per source and equal-width bucket; the top edge belongs to the last bucket."""
    bucket = F.least(
        F.width_bucket(F.col("interest_score"), F.lit(low), F.lit(high), F.lit(buckets)),
        F.when(F.col("interest_score") <= high, F.lit(buckets)).otherwise(F.lit(buckets + 1)),
    ).cast("int")
    counts = (
        star.interest.where(F.col("interest_score").isNotNull())
        .groupBy("source_id", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (high - low) / buckets
    return star.name_sources(counts).select(
        "source_name",
        "bucket",
        rounded(F.lit(low) + (F.col("bucket") - 1) * F.lit(width), 4).alias("bucket_low"),
        "n",
    ).orderBy("source_name", "bucket")


def weekly_trend(star: Star, source: str | None = None) -> DataFrame:
    """Mean score per week, entity and source, or of one source."""
    means = star.interest_of(source).groupBy("date_id", "entity_id", "source_id").agg(
        F.avg("interest_score").alias("mean")
    )
    return star.name_sources(star.name_entities(means)).select(
        key_to_date(F.col("date_id")).alias("date"),
        "entity_name",
        "source_name",
        rounded(F.col("mean")).alias("avg_interest_score"),
    ).orderBy("entity_name", "source_name", "date")
