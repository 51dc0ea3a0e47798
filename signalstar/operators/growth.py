"""Growth between the first and the last days of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.functions.calendar import date_key, key_to_date, key_year
from signalstar.functions.measures import growth_pct, per_million, rounded
from signalstar.plans.star import Star

WINDOW_DAYS = 90


def date_bounds(rows: DataFrame, key: str = "date_id") -> DataFrame:
    """One row: the first and the last date of ``rows``. Which rows bound the windows
    is the caller's choice, since it changes the answer."""
    return rows.agg(
        key_to_date(F.min(key)).alias("min_date"), key_to_date(F.max(key)).alias("max_date")
    )


def tag_period(rows: DataFrame, bounds: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Keep the rows of the two windows and tag them ``baseline`` or ``current``.

    Both limits are strict, and a row in both windows is baseline. The limits are
    scalar subqueries on the integer key: computed once, and pushed into the scan of
    a fact table, so only the two windows are read.
    """
    first_out = bounds.select(date_key(F.date_add("min_date", days))).scalar()
    last_out = bounds.select(date_key(F.date_sub("max_date", days))).scalar()
    key = F.col("date_id")
    return rows.where((key < first_out) | (key > last_out)).withColumn(
        "period", F.when(key < first_out, F.lit("baseline")).otherwise(F.lit("current"))
    )


def _period_mean(period: str) -> Column:
    return F.avg(F.when(F.col("period") == period, F.col("interest_score")))


def period_growth(tagged: DataFrame, *keys: str) -> DataFrame:
    """Both means and the growth, unrounded; a window without rows gives NULL."""
    means = [
        _period_mean("baseline").alias("baseline"),
        _period_mean("current").alias("current"),
    ]
    grouped = tagged.groupBy(*keys).agg(*means) if keys else tagged.agg(*means)
    return grouped.withColumn("growth", growth_pct(F.col("current"), F.col("baseline")))


def _report(grown: DataFrame, *columns: str, growth_name: str = "growth_pct") -> DataFrame:
    return grown.select(
        *columns,
        rounded(F.col("baseline")).alias("baseline_avg"),
        rounded(F.col("current")).alias("current_avg"),
        rounded(F.col("growth")).alias(growth_name),
    )


def overall_growth(
    star: Star, source: str, days: int = WINDOW_DAYS, national_only: bool = False
) -> DataFrame:
    """KPI 9.1. By default regional snapshot rows count along with national ones, as
    the published figures do; ``national_only`` leaves them out."""
    rows = star.interest_of(source, national_only=national_only)
    grown = period_growth(tag_period(rows, date_bounds(rows), days))
    return _report(grown, growth_name="overall_growth_pct")


def entity_growth(
    star: Star, source: str, days: int = WINDOW_DAYS, national_only: bool = False
) -> DataFrame:
    """KPI 9.3: growth per entity, fastest first."""
    rows = star.interest_of(source, national_only=national_only)
    grown = period_growth(tag_period(rows, date_bounds(rows), days), "entity_id")
    return _report(star.name_entities(grown), "entity_name").orderBy(
        F.desc_nulls_last("growth_pct"), "entity_name"
    )


def entity_source_growth(star: Star, days: int = WINDOW_DAYS) -> DataFrame:
    """Growth per entity and source with the bounds of the whole calendar. A source
    whose data end before the calendar has no current window, hence NULL growth."""
    tagged = tag_period(star.interest, date_bounds(star.dates), days)
    grown = period_growth(tagged, "entity_id", "source_id")
    named = star.name_sources(star.name_entities(grown))
    return _report(named, "entity_name", "source_name").orderBy(
        F.desc_nulls_last("growth_pct"), "entity_name", "source_name"
    )


def region_growth(star: Star, days: int = WINDOW_DAYS, with_population: bool = False) -> DataFrame:
    """KPI 9.4: growth per region, bounded by the regional rows alone; the bounds of
    all rows would leave the current window of every region empty."""
    rows = star.interest_of(regional=True)
    grown = period_growth(tag_period(rows, date_bounds(rows), days), "region_id")
    extra = ["population"] if with_population else []
    return _report(star.name_regions(grown, *extra), "region_name", *extra).orderBy(
        F.desc_nulls_last("growth_pct"), "region_name"
    )


def top_growing(star: Star, source: str, days: int = WINDOW_DAYS) -> DataFrame:
    """The single fastest entity and the single fastest region."""
    entity = entity_growth(star, source, days).limit(1)
    region = region_growth(star, days).limit(1)
    return entity.select(
        F.lit("entity").alias("kind"), F.col("entity_name").alias("name"), "growth_pct"
    ).unionByName(
        region.select(
            F.lit("region").alias("kind"), F.col("region_name").alias("name"), "growth_pct"
        )
    )


def reporting_bounds(star: Star, source: str) -> DataFrame:
    """First and last calendar date that carry rows of one source, over all rows and
    over its regional rows."""
    def bounded(rows: DataFrame, scope: str) -> DataFrame:
        # Distinct first: the fact shrinks to its weeks before it is shuffled.
        weeks = rows.select("date_id").distinct()
        dates = star.dates.join(weeks, "date_id", "left_semi")
        return dates.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date")).select(
            F.lit(scope).alias("scope"), "min_date", "max_date"
        )

    return bounded(star.interest_of(source), "all").unionByName(
        bounded(star.interest_of(source, regional=True), "regional")
    )


def year_over_year(star: Star, source: str, complete_years_only: bool = False) -> DataFrame:
    """KPI 9.2: the newest year present, full or not, against the year before.

    One scan: yearly means first, then a lookup among them, one entry per year.
    """
    yearly = (
        star.interest_of(source)
        .groupBy(key_year(F.col("date_id")).alias("year"))
        .agg(
            F.avg("interest_score").alias("mean"),
            F.min("date_id").alias("first"),
            F.max("date_id").alias("last"),
        )
    )
    if complete_years_only:
        yearly = yearly.where(
            (F.col("first") % 10000 <= 107) & (F.col("last") % 10000 >= 1225)
        )
    folded = yearly.agg(
        F.max("year").alias("current_year"),
        F.map_from_entries(F.collect_list(F.struct("year", "mean"))).alias("means"),
    )
    current = F.try_element_at("means", F.col("current_year"))
    prior = F.try_element_at("means", F.col("current_year") - 1)
    return folded.select(
        "current_year",
        (F.col("current_year") - 1).alias("prior_year"),
        rounded(current).alias("current_year_avg"),
        rounded(prior).alias("prior_year_avg"),
        rounded(growth_pct(current, prior)).alias("yoy_growth_pct"),
    )


def regional_detail(star: Star) -> DataFrame:
    """Every regional row with its names and date."""
    rows = star.interest_of(regional=True)
    named = star.name_entities(star.name_regions(rows, many=True), many=True)
    return named.select(
        "region_name", "entity_name", key_to_date(F.col("date_id")).alias("date"),
        "interest_score",
    ).orderBy("region_name", "entity_name", "date")


def region_per_million(star: Star) -> DataFrame:
    """Mean score per million people of each region."""
    means = star.interest_of(regional=True).groupBy("region_id").agg(
        F.avg("interest_score").alias("mean")
    )
    return star.name_regions(means, "population").select(
        "region_name",
        "population",
        rounded(F.col("mean")).alias("raw_avg_interest"),
        rounded(per_million(F.col("mean"), F.col("population")), 4).alias(
            "interest_per_million_pop"
        ),
    ).orderBy(F.desc_nulls_last("interest_per_million_pop"), "region_name")


def total_per_million(star: Star, source: str) -> DataFrame:
    """The same measure ungrouped: the mean over all regional rows of a source per
    million of the summed population."""
    mean = star.interest_of(source, regional=True).agg(F.avg("interest_score").alias("mean"))
    people = star.regions.agg(F.sum("population")).scalar()
    return mean.select(
        rounded(per_million(F.col("mean"), people), 4).alias("interest_per_million_pop")
    )
