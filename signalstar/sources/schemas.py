"""Explicit schemas of raw files and of the finished tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TREND_LINE = _row(label=T.StringType(), value=T.StringType(), anchor=T.StringType())

ARTICLE = _row(
    url=T.StringType(), title=T.StringType(), seendate=T.StringType(),
    domain=T.StringType(), language=T.StringType(), sourcecountry=T.StringType(),
)
NEWS_FILE = _row(articles=T.ArrayType(ARTICLE))

PAGEVIEW = _row(timestamp=T.StringType(), views=T.LongType())
PAGEVIEW_FILE = _row(items=T.ArrayType(PAGEVIEW))

GEOGRAPHY = _row(
    code=T.StringType(), name=T.StringType(),
    population_by_year=T.MapType(T.StringType(), T.LongType()),
)
POPULATION_FILE = _row(
    source=T.StringType(), unit=T.StringType(), geographies=T.ArrayType(GEOGRAPHY)
)

PLACES = _row(code=T.StringType(), name=T.StringType())
REGION_KEYS = _row(region_id=T.IntegerType(), region_name=T.StringType())

ENTITIES = _row(
    entity_id=T.IntegerType(), entity_name=T.StringType(), primary_usage=T.StringType(),
    price_range=T.StringType(), approved=T.BooleanType(),
)
REGIONS = _row(region_id=T.IntegerType(), region_name=T.StringType(), population=T.LongType())
SOURCES = _row(
    source_id=T.IntegerType(), source_name=T.StringType(), reliability=T.IntegerType()
)
DATES = _row(
    date_id=T.IntegerType(), date=T.DateType(), month=T.IntegerType(),
    quarter=T.IntegerType(), year=T.IntegerType(),
)
INTEREST = _row(
    date_id=T.IntegerType(), entity_id=T.IntegerType(), region_id=T.IntegerType(),
    source_id=T.IntegerType(), interest_score=T.DoubleType(),
)
EVENTS = _row(
    event_date=T.DateType(), related_article_count=T.LongType(), source_count=T.LongType(),
    category=T.StringType(), title=T.StringType(), region_id=T.IntegerType(),
    entity_id=T.IntegerType(),
)

# The tables in the order their keys demand: dimensions before facts.
TABLES = {
    "entities": ENTITIES,
    "regions": REGIONS,
    "sources": SOURCES,
    "dates": DATES,
    "interest": INTEREST,
    "events": EVENTS,
}
DIMENSIONS = ("entities", "regions", "sources", "dates")
FACTS = ("interest", "events")
