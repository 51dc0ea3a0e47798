"""Raw-shaped input derived from the test tables, so that the readers' expansions and
cleaning rules run over whole tables: bodies and lines in the layouts of the raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.functions.calendar import key_to_date
from signalstar.functions.cleaning import NEWS_STAMP, PUBLICATION_STAMP
from signalstar.operators.sizing import measured
from signalstar.plans.order_star import (
    interest,
    regions,
    segment_name,
    table,
    with_customer,
)


def placed_events(spark: SparkSession, folder: str) -> DataFrame:
    return with_customer(spark, folder, table(spark, folder, "events"), "user_id")


def news_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One body per event with two articles, of which the first has no title."""
    stamp = F.date_format("ts", NEWS_STAMP)
    domain = F.concat(F.lit("user"), F.col("user_id").cast("string"))

    def article(title):
        return F.struct(title.alias("title"), stamp.alias("seendate"), domain.alias("domain"))

    articles = F.array(article(F.lit(None).cast("string")), article(F.col("props")))
    return placed_events(spark, folder).select(
        F.concat("entity_id", F.lit(".json")).alias("file_name"),
        "event_id",
        F.to_json(F.struct(articles.alias("articles"))).alias("body"),
    )


def publication_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One body per event: its id is the uid and the key of its record."""
    record = F.to_json(
        F.struct(
            F.date_format("ts", PUBLICATION_STAMP).alias("sortpubdate"),
            F.col("event_type").alias("fulljournalname"),
            F.col("props").alias("title"),
        )
    )
    uid = F.col("event_id").cast("string")
    return placed_events(spark, folder).select(
        F.concat(F.lower("entity_id"), F.lit("_summary.json")).alias("file_name"),
        "event_id",
        F.concat(
            F.lit('{"result":{"uids":["'), uid, F.lit('"],"'), uid, F.lit('":'), record, F.lit("}}")
        ).alias("body"),
    )


def pageview_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One body per event: its hour and its rounded value as views."""
    item = F.struct(
        F.date_format("ts", "yyyyMMddHH").alias("timestamp"),
        F.floor("value").cast("bigint").alias("views"),
    )
    return placed_events(spark, folder).select(
        F.concat("entity_id", F.lit("_pageviews.json")).alias("file_name"),
        F.to_json(F.struct(F.array(item).alias("items"))).alias("body"),
    )


def yearly_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per nation and year."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("people"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def population_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One body per nation; year 999 sorts last as text but not as a number. A nation
    has one entry per calendar year."""
    by_year = F.map_concat(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("year").cast("string"), F.col("people")))
        ),
        F.create_map(F.lit("999"), F.lit(1).cast("bigint")),
    )
    places = yearly_orders(spark, folder).groupBy("n_nationkey", "n_name").agg(
        by_year.alias("population_by_year")
    )
    place = F.struct(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"),
        F.col("n_name").alias("name"),
        "population_by_year",
    )
    return places.select(
        F.lit("population.json").alias("file_name"),
        F.to_json(F.struct(F.array(place).alias("geographies"))).alias("body"),
    )


def population_sheet(spark: SparkSession, folder: str, years: list[int]) -> DataFrame:
    """Orders per nation as a wide sheet: Code, Name, Mid-1995, …"""
    wide = yearly_orders(spark, folder).groupBy("n_nationkey", "n_name").pivot("year", years).agg(
        F.sum("people")
    )
    return wide.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("Code"),
        F.col("n_name").alias("Name"),
        *[F.col(str(y)).alias(f"Mid-{y}") for y in years],
    )


def nation_codes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"),
        F.col("n_name").alias("name"),
    )


def national_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly mean order value per segment as score text: ``<1`` below 180,000."""
    weekly = interest(spark, folder).groupBy("entity_id", "date_id").agg(
        F.avg("interest_score").alias("mean")
    )
    score = F.floor(F.col("mean") / 5000.0).cast("bigint").cast("string")
    return weekly.select(
        F.concat(F.lit("Peptides_"), "entity_id", F.lit(".csv")).alias("file_name"),
        key_to_date(F.col("date_id")).cast("string").alias("label"),
        F.when(F.col("mean") < 180000.0, F.lit("<1")).otherwise(score).alias("value"),
    )


def _write_lines(lines: DataFrame, path: str, header: str) -> str:
    """Lines as one export per file name, below a preamble and a header; returns the glob."""
    above = [("Category: All categories", None), (header, "Score")]
    top = lines.select("file_name").distinct().select(
        "file_name",
        F.inline(F.array(*[
            F.struct(F.lit(a).alias("label"), F.lit(b).cast("string").alias("value")) for a, b in above
        ])),
    )
    whole = top.unionByName(lines).withColumn("anchor", F.lit("100"))
    whole.write.partitionBy("file_name").csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return f"{path}/file_name=*"


def _write_bodies(bodies: DataFrame, path: str) -> str:
    bodies.select("file_name", "body").write.partitionBy("file_name").text(path)
    return f"{path}/file_name=*"


def write_exports(spark: SparkSession, folder: str, target: str) -> dict[str, str]:
    """Lines and bodies as real files below ``target``: the path of each raw source."""
    return {
        "national": _write_lines(national_lines(spark, folder), f"{target}/national", "Week"),
        "regional": _write_lines(regional_lines(spark, folder), f"{target}/regional", "Region"),
        "news": _write_bodies(news_bodies(spark, folder), f"{target}/news"),
        "publications": _write_bodies(publication_bodies(spark, folder), f"{target}/publications"),
        "pageviews": _write_bodies(pageview_bodies(spark, folder), f"{target}/pageviews"),
    }


def write_sheet(spark: SparkSession, folder: str, years: list[int], path: str) -> DataFrame:
    """The wide sheet as a file whose header stands below a title, read back cell by cell."""
    sheet = population_sheet(spark, folder, years)
    cells = [f"c{i}" for i in range(len(sheet.columns))]
    title = [F.lit("Mid-year estimates"), *[F.lit(None)] * (len(cells) - 1)]
    above = spark.range(1).select(F.inline(F.array(*[
        F.struct(*[v.cast("string").alias(c) for c, v in zip(cells, row)])
        for row in (title, [F.lit(name) for name in sheet.columns])
    ])))
    body = sheet.select(*[F.col(n).cast("string").alias(c) for n, c in zip(sheet.columns, cells)])
    above.unionByName(body).write.csv(path)
    return spark.read.schema(body.schema).csv(path)


def percent_text(number):
    """Percent cells of every kind: blank, missing, below one, one decorated, plain."""
    return (
        F.when(number % 7 == 0, F.lit(" "))
        .when(number % 7 == 1, F.lit(None).cast("string"))
        .when(number % 7 == 2, F.lit("<1%"))
        .when(number % 7 == 3, F.lit("<10%"))
        .when(number % 7 == 4, F.concat(F.lit("  "), number.cast("string"), F.lit("% ")))
        .otherwise(F.concat(number.cast("string"), F.lit("%")))
    )


def regional_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order counts per segment, region and window (before or from 1998) as percents."""
    window = F.when(F.col("date_id") < 19980101, F.lit("baseline")).otherwise(F.lit("current"))
    counts = (
        interest(spark, folder)
        .where(F.col("region_id").isNotNull())
        .groupBy("entity_id", "region_id", window.alias("window"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(regions(spark, folder), "region_id")
    )
    return counts.select(
        F.concat("entity_id", F.lit("_"), "window", F.lit(".csv")).alias("file_name"),
        F.lower("region_name").alias("label"),
        percent_text(F.col("n") % 100).alias("value"),
    )


def named_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Segments by their display name, for resolving file names without regard to case."""
    names = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("entity_id"),
        segment_name(F.col("c_mktsegment")).alias("entity_name"),
    ).distinct()
    return measured(names)[0]
