"""What is in the tables: counts, gaps and column summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstar.functions.measures import rounded, share_pct
from signalstar.operators.percentiles import group_percentiles
from signalstar.plans.star import Star


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stacked(
        [
            t.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, t in tables.items()
        ]
    )


def null_regions(star: Star) -> DataFrame:
    """Rows without a region in each fact."""
    return _stacked(
        [
            star.table(name).agg(
                F.count_if(F.col("region_id").isNull()).alias("null_region_id"),
                F.count(F.lit(1)).alias("total_rows"),
            ).select(F.lit(name).alias("table_name"), "null_region_id", "total_rows")
            for name in ("interest", "events")
        ]
    )


def null_region_rate(star: Star) -> DataFrame:
    """Share of rows without a region per source."""
    counts = star.interest.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("region_id").isNull()).alias("null_region_rows"),
    )
    return star.name_sources(counts).select(
        "source_name",
        "total_rows",
        "null_region_rows",
        rounded(share_pct(F.col("null_region_rows"), F.col("total_rows"))).alias(
            "pct_null_region_id"
        ),
    ).orderBy(F.desc("pct_null_region_id"), "source_name")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once; null keys compare as equal."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .orderBy(F.desc("n"), *keys)
    )


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Null count of every column of every table: one pass per table."""
    profiles = []
    for name, t in tables.items():
        counts = t.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in t.columns])
        profiles.append(
            counts.unpivot([], t.columns, "column_name", "null_count").select(
                F.lit(name).alias("table_name"), "column_name", "null_count"
            )
        )
    return _stacked(profiles)


def date_range(star: Star) -> DataFrame:
    return star.dates.agg(
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        F.count(F.lit(1)).alias("n_weeks"),
    )


def _fact_rows(star: Star, dim: DataFrame, key: str, name: str) -> DataFrame:
    """Fact rows per member of a dimension, zero-filled; facts are counted first, so
    the join meets one row per key."""
    def counted(fact: DataFrame, alias: str) -> DataFrame:
        return fact.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.count(F.lit(1)).alias(alias)
        )

    joined = (
        dim.select(key, name)
        .join(counted(star.interest, "interest_rows"), key, "left")
        .join(counted(star.events, "event_rows"), key, "left")
    )
    return joined.select(
        key,
        name,
        F.coalesce("interest_rows", F.lit(0)).cast("bigint").alias("interest_rows"),
        F.coalesce("event_rows", F.lit(0)).cast("bigint").alias("event_rows"),
    ).orderBy("interest_rows", "event_rows", key)


def entity_coverage(star: Star) -> DataFrame:
    return _fact_rows(star, star.entities, "entity_id", "entity_name")


def region_coverage(star: Star) -> DataFrame:
    return _fact_rows(star, star.regions, "region_id", "region_name")


def entity_list(star: Star) -> DataFrame:
    return star.entities.orderBy("entity_id")


def regions_by_population(star: Star) -> DataFrame:
    return star.regions.orderBy(F.desc_nulls_last("population"), "region_id")


def sources_by_reliability(star: Star) -> DataFrame:
    return star.sources.orderBy(F.desc_nulls_last("reliability"), "source_id")


def describe_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its count for each column.

    Columns become (column, value) pairs that are counted before anything is compared,
    so a frequent value costs one row. Among equally frequent values the smallest is
    shown.
    """
    columns = columns or df.columns
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = (
        texts.unpivot([], columns, "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count("value").alias("n"))
    )
    # Most frequent first, then smallest value: the minimum of (-n, value).
    return (
        counted.groupBy("column_name")
        .agg(
            F.sum("n").cast("bigint").alias("n_values"),
            F.count("value").alias("n_unique"),
            F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("fewer"), "value"))).alias("m"),
        )
        .select(
            "column_name",
            "n_values",
            "n_unique",
            F.col("m.value").alias("top"),
            (-F.col("m.fewer")).alias("freq"),
        )
    )


def describe_numbers(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of a number per group."""
    stats = {
        "n_values": F.count(value),
        "mean": rounded(F.avg(value), 4),
        "std": rounded(F.stddev(value), 4),
        "min": F.min(value).cast("double"),
        "max": F.max(value).cast("double"),
    }
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = group_percentiles(df, keys, value, quartiles, stats=stats)
    return found.withColumns({q: rounded(F.col(q), 4) for q in quartiles})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
