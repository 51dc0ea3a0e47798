"""Raw source folders to a checked star, as one lazy plan per table.

Every source is one scan over all of its files; there is no loop over entities.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.functions.calendar import WINDOW_END, WINDOW_START, calendar, key_to_date
from signalstar.functions.cleaning import NEWS_STAMP, PUBLICATION_STAMP, stamp_week
from signalstar.operators import quality as Q
from signalstar.operators.facts import (
    event_rollup,
    in_window,
    interest_rows,
    own_peak_index,
    weekly_totals,
)
from signalstar.operators.resolve import resolve_ids
from signalstar.plans.star import Star
from signalstar.plans.warehouse import Audit
from signalstar.sources import documents as docs
from signalstar.sources import reference_rows as ref
from signalstar.sources.schemas import DIMENSIONS
from signalstar.sources.trends import national_rows, read_trend_lines, regional_rows


@dataclass(frozen=True)
class RawPaths:
    """Glob or folder of each raw source; a source that is absent is None."""

    national: str | None = None
    regional: str | None = None
    news: str | None = None
    publications: str | None = None
    pageviews: str | None = None
    population: str | None = None
    bodies_per_line: bool = False  # JSON exports hold one body per line


def with_entity(df: DataFrame, entities: DataFrame, name: str = "entity_name") -> DataFrame:
    return resolve_ids(df, name, entities, "entity_name", "entity_id")


def _source_id(sources: DataFrame, name: str):
    return sources.where(F.col("source_name") == name).select("source_id").scalar()


# A region that no dimension row has, for snapshot lines whose region is not known: left
# NULL they would pass for national rows.
UNKNOWN_REGION = -1


def national_facts(
    national: DataFrame, entities: DataFrame, sources: DataFrame,
    source_name: str = ref.TREND_SOURCE,
) -> DataFrame:
    """National weeks, which have no region."""
    return interest_rows(with_entity(national, entities), _source_id(sources, source_name))


def regional_facts(
    regional: DataFrame, entities: DataFrame, regions: DataFrame, sources: DataFrame,
    source_name: str = ref.TREND_SOURCE,
) -> DataFrame:
    """Regional snapshots; the foreign key check finds those of unknown regions."""
    placed = resolve_ids(
        with_entity(regional, entities), "region_name", regions, "region_name", "region_id"
    )
    region = F.coalesce("region_id", F.lit(UNKNOWN_REGION))
    return interest_rows(placed, _source_id(sources, source_name), region)


def trend_facts(
    national: DataFrame, regional: DataFrame, entities: DataFrame, regions: DataFrame,
    sources: DataFrame, source_name: str = ref.TREND_SOURCE,
) -> DataFrame:
    """National weeks and regional snapshots on one grain."""
    return national_facts(national, entities, sources, source_name).unionByName(
        regional_facts(regional, entities, regions, sources, source_name)
    )


def pageview_facts(
    daily: DataFrame, entities: DataFrame, sources: DataFrame,
    source_name: str = ref.PAGEVIEW_SOURCE,
) -> DataFrame:
    weekly = weekly_totals(with_entity(daily, entities), "date", "views")
    return interest_rows(own_peak_index(weekly), _source_id(sources, source_name))


def article_weeks(rows: DataFrame, entities: DataFrame, layout: str, category: str) -> DataFrame:
    """Articles with entity, week and category, ready for the rollup."""
    return with_entity(rows, entities).select(
        "entity_id",
        stamp_week(F.col("stamp"), layout).alias("week"),
        F.lit(None).cast("int").alias("region_id"),
        F.lit(category).alias("category"),
        "publisher",
        "title",
        "pos",
    )


def news_facts(articles: DataFrame, entities: DataFrame) -> DataFrame:
    """News rows outside the window stay, so that the check on dates can fail."""
    return event_rollup(article_weeks(articles, entities, NEWS_STAMP, ref.NEWS_CATEGORY))


def publication_facts(
    rows: DataFrame, entities: DataFrame, first=WINDOW_START, last=WINDOW_END
) -> DataFrame:
    weeks = article_weeks(rows, entities, PUBLICATION_STAMP, ref.PUBLICATION_CATEGORY)
    return event_rollup(in_window(weeks, "week", first, last))


def region_dimension(staged: DataFrame, keys: DataFrame) -> DataFrame:
    return keys.join(staged.select("region_name", "population"), "region_name", "left").select(
        "region_id", "region_name", "population"
    )


def _entity_column(bodies: DataFrame, suffix: str) -> DataFrame:
    return bodies.withColumn("entity_name", docs.entity_of_file(suffix))


def raw_star(
    spark: SparkSession, paths: RawPaths, entities: DataFrame | None = None,
    sources: DataFrame | None = None, region_keys: DataFrame | None = None,
) -> Star:
    """The whole star from raw files. Nothing is read until a table is used."""
    entities = ref.entity_rows(spark) if entities is None else entities
    sources = ref.source_rows(spark) if sources is None else sources
    keys = ref.region_keys(spark) if region_keys is None else region_keys

    if paths.population:
        # Regions of a caller's own are matched by name in the dimension itself.
        names = [name for name, _ in ref.REGION_CODES] if region_keys is None else None
        staged = docs.populations(docs.read_bodies(spark, paths.population), names)
        regions = region_dimension(staged, keys)
    else:
        regions = keys.withColumn("population", F.lit(None).cast("bigint"))

    def bodies(path: str) -> DataFrame:
        return docs.read_bodies(spark, path, paths.bodies_per_line)

    interest, events = [], []
    if paths.national:
        lines = read_trend_lines(spark, paths.national)
        interest.append(national_facts(national_rows(lines), entities, sources))
    if paths.regional:
        lines = read_trend_lines(spark, paths.regional)
        interest.append(regional_facts(regional_rows(lines), entities, regions, sources))
    if paths.pageviews:
        views = docs.pageviews(bodies(paths.pageviews))
        interest.append(
            pageview_facts(_entity_column(views, docs.PAGEVIEW_SUFFIX), entities, sources)
        )
    if paths.news:
        news = docs.news_articles(bodies(paths.news))
        events.append(news_facts(_entity_column(news, docs.NEWS_SUFFIX), entities))
    if paths.publications:
        found = docs.publications(bodies(paths.publications))
        events.append(publication_facts(_entity_column(found, docs.PUBLICATION_SUFFIX), entities))
    if not interest or not events:
        raise ValueError("a star needs an interest source and an event source")
    return Star(
        entities=entities,
        regions=regions,
        sources=sources,
        dates=calendar(spark),
        interest=_union(interest),
        events=_union(events),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def interest_rules(expected_regional: int | None = None) -> list:
    """``expected_regional`` is regions × entities × windows."""
    rules: list = Q.no_nulls("date_id", "entity_id", "source_id", "interest_score")
    rules += [
        Q.date_bounds("date_id", key_to_date(F.col("date_id"))),
        Q.within("interest_score", 0, 100),
    ]
    if expected_regional is not None:
        rules.append(Q.regional_row_count(expected_regional))
    return rules


def event_rules() -> list:
    rules: list = Q.no_nulls(
        "event_date", "related_article_count", "source_count", "category", "title", "entity_id"
    )
    return rules + [
        Q.date_bounds("event_date"),
        Q.at_least("related_article_count", 1),
        Q.at_least("source_count", 1),
        Q.not_above("source_count", "related_article_count"),
    ]


def audits(expected_regional: int | None = None, expected_regions: int | None = None) -> dict[str, Audit]:
    """All rules of the six tables; a load adds the keys of the facts by itself."""
    regions: list = Q.no_nulls("region_id", "region_name", "population")
    if expected_regions is not None:
        regions.append(Q.row_count(expected_regions))
    return {
        "entities": Audit(Q.no_nulls("entity_id", "entity_name", "approved"), ["entity_id"]),
        "regions": Audit(regions, ["region_id"]),
        "sources": Audit(Q.no_nulls("source_id", "source_name", "reliability"), ["source_id"]),
        "dates": Audit(Q.no_nulls("date_id", "date", "month", "quarter", "year"), ["date_id"]),
        "interest": Audit(interest_rules(expected_regional)),
        "events": Audit(event_rules()),
    }


def interest_report(star: Star, expected_regional: int | None = None) -> DataFrame:
    """All checks on interest rows."""
    keys = star.foreign_keys("interest")
    return Q.report(star.interest, "interest", interest_rules(expected_regional), keys)


def event_report(star: Star) -> DataFrame:
    return Q.report(star.events, "events", event_rules(), star.foreign_keys("events"))


def dimension_report(star: Star, expected_regions: int | None = None) -> DataFrame:
    found = audits(expected_regions=expected_regions)
    return reduce(DataFrame.unionByName, [
        Q.report(star.table(name), name, found[name].rules, unique=found[name].unique)
        for name in DIMENSIONS
    ])
