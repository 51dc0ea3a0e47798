"""JSON sources.

The expansions use outer explodes and drop the empty row afterwards: for an inner explode
Catalyst adds a filter on the array, for which every body would be parsed once more. A body
that cannot be read keeps its empty row, so that the checks count it instead of losing it.

Each reader is a scan that yields ``file_name, body`` plus an
expansion of the body, so the same expansion also serves bodies kept in a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.functions.cleaning import latest_year, pageview_day
from signalstar.sources.schemas import (
    NEWS_FILE,
    PAGEVIEW_FILE,
    POPULATION_FILE,
)
from signalstar.sources.tables import export_name

# File names after the entity name.
NEWS_SUFFIX = ".json"
PUBLICATION_SUFFIX = "_summary.json"
PAGEVIEW_SUFFIX = "_pageviews.json"


def read_bodies(
    spark: SparkSession, path: str | list[str], per_line: bool = False
) -> DataFrame:
    """One row per file, or per line where many bodies are kept in an export's part files.

    A file read as a whole is one row of one task; the sources cap what it holds. Large
    collections are read by line, which splits.
    """
    return spark.read.text(path, wholetext=not per_line).select(
        export_name().alias("file_name"), F.col("value").alias("body")
    )


def entity_of_file(suffix: str):
    """The entity part of a file name; casing is settled when the id is resolved."""
    return F.regexp_extract("file_name", "^(.*)" + suffix.replace(".", r"\.") + "$", 1)


def _carried(bodies: DataFrame) -> list[str]:
    """Every column but the body goes along: the file name and what a caller added."""
    return [c for c in bodies.columns if c != "body"]


def news_articles(bodies: DataFrame) -> DataFrame:
    """One row per article with its position, which is its relevance rank."""
    kept = _carried(bodies)
    parsed = bodies.select(
        *kept, F.from_json("body", NEWS_FILE).getField("articles").alias("articles")
    )
    listed = parsed.select(
        *kept, "articles", F.posexplode_outer("articles").alias("pos", "article")
    )
    return listed.where(F.col("pos").isNotNull() | F.col("articles").isNull()).select(
        *kept,
        "pos",
        F.col("article.seendate").alias("stamp"),
        F.col("article.domain").alias("publisher"),
        F.col("article.title").alias("title"),
    )


def publications(bodies: DataFrame) -> DataFrame:
    """One row per listed uid, in the order of the ``uids`` array."""
    return publication_records(bodies).drop("problem")


def publication_records(bodies: DataFrame) -> DataFrame:
    """``publications`` with a column ``problem``.

    A body is parsed once, into a variant whose records are looked up by uid. ``problem`` tells
    why a stamp is missing: ``body`` (no JSON), ``uids`` (no list of them), ``record`` (none
    under that uid) or ``stamp`` (none in the record).
    """
    kept = _carried(bodies)
    parsed = bodies.select(*kept, F.try_parse_json("body").alias("doc")).select(
        *kept,
        F.col("doc").isNotNull().alias("readable"),
        F.try_variant_get("doc", "$.result.uids", "array<string>").alias("uids"),
        F.try_variant_get("doc", "$.result", "map<string,variant>").alias("records"),
    )
    listed = parsed.select(
        *kept, "readable", "uids", "records", F.posexplode_outer("uids").alias("pos", "uid")
    ).where(F.col("pos").isNotNull() | F.col("uids").isNull())
    named = listed.select(
        *kept, "pos", "uid", "readable", "uids", F.col("records")[F.col("uid")].alias("record")
    )

    def field(name: str):
        return F.try_variant_get("record", f"$.{name}", "string")

    problem = (
        F.when(~F.col("readable"), "body").when(F.col("uids").isNull(), "uids")
        .when(F.col("record").isNull(), "record").when(field("sortpubdate").isNull(), "stamp")
    )
    return named.select(
        *kept,
        "pos",
        "uid",
        field("sortpubdate").alias("stamp"),
        field("fulljournalname").alias("publisher"),
        field("title").alias("title"),
        problem.alias("problem"),
    )


def pageviews(bodies: DataFrame) -> DataFrame:
    """``file_name, date, views``, one row per day."""
    kept = _carried(bodies)
    parsed = bodies.select(
        *kept, F.from_json("body", PAGEVIEW_FILE).getField("items").alias("items")
    )
    listed = parsed.select(*kept, "items", F.explode_outer("items").alias("item"))
    return listed.where(F.col("item").isNotNull() | F.col("items").isNull()).select(
        *kept,
        pageview_day(F.col("item.timestamp")).alias("date"),
        F.col("item.views").alias("views"),
    )


def populations(bodies: DataFrame, region_names: list[str] | None) -> DataFrame:
    """The newest figure of every known (None: every) region: code, name, population, year. A
    body that cannot be read stays as a row of NULLs."""
    parsed = bodies.select(F.from_json("body", POPULATION_FILE).getField("geographies").alias("g"))
    places = parsed.select(F.explode_outer("g").alias("place")).select("place.*")
    if region_names is not None:
        places = places.where(F.col("name").isNull() | F.col("name").isin(*region_names))
    return newest_population(places)


def newest_population(places: DataFrame) -> DataFrame:
    """``ons_code, region_name, population, year`` from code, name, year-to-count map."""
    return places.withColumn("year", latest_year(F.col("population_by_year"))).select(
        F.col("code").alias("ons_code"),
        F.col("name").alias("region_name"),
        F.col("population_by_year")[F.col("year")].alias("population"),
        "year",
    )
