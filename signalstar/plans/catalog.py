"""Every query by name, each a function of a session and a folder of tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstar.functions.calendar import (
    date_key,
    key_to_date,
    quarter_end,
    quarter_label,
    week_start,
    weeks_between,
)
from signalstar.functions.cleaning import (
    PUBLICATION_STAMP,
    national_score,
    percent_score,
    sentence_case,
    stamp_week,
)
from signalstar.functions.measures import rounded
from signalstar.operators import (
    coverage,
    cross_source,
    cube,
    distribution,
    events,
    growth,
    lift,
    profile,
    quality,
    ranking,
    resolve,
    score_sketches,
    spikes,
    titles,
)
from signalstar.operators.facts import event_rollup
from signalstar.plans import derived_sources as derived
from signalstar.plans import incremental, raw_star
from signalstar.plans.order_star import (
    FIRST_SOURCE,
    SECOND_SOURCE,
    THIRD_SOURCE,
    articles,
    order_star,
    table,
    with_customer,
)
from signalstar.plans.star import Star
from signalstar.plans.warehouse import load_star
from signalstar.session import scratch_path
from signalstar.sources import documents as docs
from signalstar.sources import reference_rows as ref
from signalstar.sources.population_sheet import places_from_sheet, with_header
from signalstar.sources.schemas import FACTS, PLACES
from signalstar.sources.tables import local_table, materialised, read_table, reload_table, save_processed
from signalstar.sources.trends import national_rows, regional_rows
from signalstar.streaming import pageviews, rollup, weekly

Query = Callable[[SparkSession, str], DataFrame]

FREQUENT_SHARE = 0.01  # of a column's cells, from which a value is listed
KNOWN_NATIONS = 20  # nations that the population query keeps, by key


def _on_star(question: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: question(order_star(spark, folder))


# --- dimensions derived from data, where the star's own are authored -----------------


def _rated_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Order statuses as sources, rated by their share of prioritised orders."""
    ranked = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double")
    return table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("source_id")).agg(
        F.concat(F.lit("status "), F.first("o_orderstatus")).alias("source_name"),
        F.floor(F.avg(ranked) * 1000).cast("int").alias("reliability"),
    )


def _event_calendar(spark: SparkSession, folder: str) -> DataFrame:
    bounds = table(spark, folder, "events").agg(
        F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last")
    )
    return weeks_between(bounds, "first", "last")


def _prof_sources(spark: SparkSession, folder: str) -> DataFrame:
    star = order_star(spark, folder).but(sources=_rated_sources(spark, folder))
    return coverage.sources_by_reliability(star)


def _events_on_calendar(spark: SparkSession, folder: str) -> DataFrame:
    star = order_star(spark, folder).but(dates=_event_calendar(spark, folder))
    return events.on_calendar(star)


# --- data quality --------------------------------------------------------------------


def _dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that some of the data break, so that the counts are not all zero."""
    star = order_star(spark, folder)
    facts = quality.report(
        star.interest,
        "interest",
        [
            *quality.no_nulls("date_id", "entity_id", "region_id", "interest_score"),
            quality.date_bounds(
                "date_id", key_to_date(F.col("date_id")), date(1995, 1, 8), date(2000, 12, 31)
            ),
            quality.valid_ids("source_id", [1, 2]),
            quality.within("interest_score", 2000, 480000),
            quality.regional_row_count(1000),
        ],
        [
            quality.ForeignKey("entity_id", star.entities, "entity_id"),
            quality.ForeignKey(
                "region_id", star.regions.where(F.col("population") > 300_000), "region_id"
            ),
            quality.ForeignKey("date_id", _event_calendar(spark, folder), "date_id"),
        ],
    )
    rolled = quality.report(
        star.events,
        "events",
        [
            *quality.no_nulls("event_date", "title"),
            quality.at_least("related_article_count", 12),
            quality.not_above("source_count", "related_article_count"),
        ],
    )
    customers = quality.report(
        table(spark, folder, "customer"), "customer", [quality.row_count(1000)], unique=["c_nationkey"]
    )
    return facts.unionByName(rolled).unionByName(customers)


def _dq_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Raw inputs of which some are broken: cut news, page-view and population bodies,
    publications whose record is missing or whose stamp is no date, and trend lines without a
    label. All are counted."""
    number = F.col("event_id")
    cut = F.when(number % 97 == 0, F.substring("body", 1, 40)).otherwise(F.col("body"))
    news = docs.news_articles(derived.news_bodies(spark, folder).withColumn("body", cut))
    odd = F.when(number % 89 == 0, F.regexp_replace("body", '"uids":\\["', '"uids":["x')).when(
        number % 83 == 0, F.regexp_replace("body", '"sortpubdate":"', '"sortpubdate":"about ')
    ).otherwise(F.col("body"))
    found = docs.publications(derived.publication_bodies(spark, folder).withColumn("body", odd))
    found = found.withColumn("week", stamp_week(F.col("stamp"), PUBLICATION_STAMP))
    blank = F.when(F.dayofyear("label") % 13 != 0, F.col("label"))
    lines = derived.national_lines(spark, folder).withColumn("label", blank)
    views = derived.pageview_bodies(spark, folder)
    hour = F.regexp_extract("body", '"timestamp":"[0-9]{8}([0-9]{2})', 1)
    views = docs.pageviews(views.withColumn(
        "body", F.when(hour == "07", F.substring("body", 1, 20)).otherwise(F.col("body"))))
    people = derived.population_bodies(spark, folder)
    people = docs.populations(people.withColumn(
        "body", F.when(F.col("body").contains('"name":"I'), "{").otherwise(F.col("body"))), None)
    stampless = quality.RowRule(
        "unreadable_stamp", "stamp", F.col("stamp").isNotNull() & F.col("week").isNull()
    )
    return (
        quality.report(news, "news", quality.no_nulls("pos"))
        .unionByName(quality.report(found, "publications", [*quality.no_nulls("stamp"), stampless]))
        .unionByName(quality.report(national_rows(lines), "national", quality.no_nulls("date")))
        .unionByName(quality.report(views, "pageviews", quality.no_nulls("date")))
        .unionByName(quality.report(people, "population", quality.no_nulls("region_name")))
    )


def _dq_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Publication bodies broken in four ways, and what each row's reader says of it."""
    number = F.col("event_id")
    odd = F.when(number % 97 == 0, F.substring("body", 1, 40)).when(
        number % 89 == 0, F.regexp_replace("body", '"uids":\\["', '"uids":["x')
    ).when(number % 83 == 0, F.regexp_replace("body", '"uids":', '"ids":')).when(
        number % 79 == 0, F.regexp_replace("body", '"sortpubdate":', '"date":')
    ).otherwise(F.col("body"))
    found = docs.publication_records(derived.publication_bodies(spark, folder).withColumn("body", odd))
    return found.groupBy("problem").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("stamp").alias("n_stamps"), F.count("title").alias("n_titles")
    )


def _src_places(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as places of the region-level extract, dealt by number: the newest figure of every
    authored place, with the id of the region that bears its code."""
    places = [*ref.REGION_PLACES, ("X00000001", "No such place")]
    numbered = local_table(
        spark, [(i, *p) for i, p in enumerate(places)], T.StructType([
            T.StructField("number", T.IntegerType()), *PLACES.fields]))
    yearly = derived.yearly_orders(spark, folder).withColumn("number", F.col("n_nationkey") % len(places))
    bodies = yearly.groupBy("number", F.col("year").cast("string").alias("year")).agg(
        F.sum("people").alias("people")
    ).groupBy("number").agg(
        F.map_from_entries(F.collect_list(F.struct("year", "people"))).alias("population_by_year")
    ).join(numbered, "number").select(
        F.to_json(F.struct(F.array(F.struct("code", "name", "population_by_year")).alias("geographies"))).alias("body")
    )
    known = [name for _, name in ref.REGION_PLACES]
    newest = docs.populations(bodies, known)
    codes = local_table(spark, [(code, name) for name, code in ref.REGION_CODES], PLACES)
    regions = ref.region_keys(spark).join(codes, F.col("region_name") == F.col("name")).select("code", "region_id")
    authored = ref.place_codes(spark, ref.REGION_PLACES).join(regions, "code", "left")
    return authored.join(newest, F.col("code") == F.col("ons_code"), "left").select(
        "code", F.col("name").alias("place"), "region_id", "population", "year"
    )


def _src_authored_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Events under authored entity names in any casing, one name unknown: rows and sum of
    values for each authored entity, and for what matches none."""
    names = [name for name, _, _ in ref.ENTITY_INFO] + ["Unheard-of"]
    named = table(spark, folder, "events").select(
        F.get(F.array(*map(F.lit, names)), (F.col("user_id") % len(names)).cast("int")).alias("name"),
        "event_id", "value",
    ).withColumn("entity_name", F.when(F.col("event_id") % 2 == 0, F.upper("name")).otherwise(F.lower("name")))
    counted = named.groupBy(F.lower("entity_name").alias("key")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value") > 0).alias("n_positive")
    )
    entities = ref.entity_rows(spark).select("entity_id", "entity_name", "approved", "primary_usage")
    return entities.join(counted, F.lower("entity_name") == F.col("key"), "full").select(
        "entity_id", "entity_name", "approved", F.length("primary_usage").alias("usage_length"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce("n_positive", F.lit(0)).cast("bigint").alias("n_positive"),
    )


def _dq_fk_offenders(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten customers of orders that are no supplier."""
    key = quality.ForeignKey("o_custkey", table(spark, folder, "supplier"), "s_suppkey")
    return quality.first_offenders(quality.orphans(table(spark, folder, "orders"), key))


def _dq_missing_authored(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_authored(order_star(spark, folder).entities, "price_range", "entity_name")


def _dq_at_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose events reach a cap of 60: their counts are lower bounds."""
    counts = table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return quality.at_cap(counts, "n", 60)


# --- events against interest ---------------------------------------------------------


def _first_source_weeks(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_star(spark, folder).interest_of(FIRST_SOURCE)
    return rows.select(
        "entity_id",
        key_to_date(F.col("date_id")).alias("date"),
        F.col("interest_score").alias("score"),
    )


def _urgent_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Segment weeks whose urgent orders reach the segment's 95th percentile."""
    orders = table(spark, folder, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    counts = (
        with_customer(spark, folder, orders, "o_custkey")
        .groupBy("entity_id", week_start(F.to_date("o_orderdate")).alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A segment has one row a week by now, so its percentile is a window over a calendar.
    limit = F.percentile("n", 0.95).over(Window.partitionBy("entity_id"))
    return counts.withColumn("limit", limit).where(F.col("n") >= F.col("limit")).select(
        "entity_id", "date"
    )


LIFT_DAYS = 14


def _daily_lift(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of the two weeks around every day on which a segment ordered urgently for over
    400,000."""
    orders = with_customer(spark, folder, table(spark, folder, "orders"), "o_custkey").select(
        "entity_id", F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("score"),
        "o_orderpriority")
    urgent = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("score") > 400_000))
    return lift.lift_at(orders, urgent, LIFT_DAYS)


SPAN = (19950101, 19961231)  # date keys of the weeks that the window query asks for


def _score_window(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of two years of weeks from stored weekly sketches, exact by one pass."""
    rows = order_star(spark, folder).interest
    cells = materialised(
        score_sketches.sketch_cells(rows, ["source_id"], "date_id", "interest_score"), "score-sketches")
    found = score_sketches.exact_span_quantiles(
        cells, rows, ["source_id"], "date_id", "interest_score", *SPAN, distribution.QUARTILES)
    return found.select("source_id", "n", *[rounded(F.col(q)).alias(q) for q in distribution.QUARTILES])


def _on_lift(question) -> Query:
    return lambda spark, folder: question(
        _first_source_weeks(spark, folder), _urgent_weeks(spark, folder)
    )


# --- sources, cleaning and facts -----------------------------------------------------


def _calendar_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Week, keys and labels of every day that has orders."""
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    week, day = week_start(F.col("day")), F.col("day")
    return days.select(
        "day",
        week.alias("week"),
        date_key(week).alias("date_id"),
        key_to_date(date_key(day)).alias("day_again"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        quarter_label(day).alias("year_quarter"),
        quarter_end(day).alias("quarter_end"),
    )


def _clean_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Both cleaning rules on a score text made from every order's value."""
    number = F.floor(F.col("o_totalprice") / 1000.0).cast("bigint")
    text = derived.percent_text(number)
    cell = F.when(number % 5 == 0, F.lit(" <1 ")).when(number % 5 == 1, F.lit("n/a")).when(
        number % 5 == 2, F.lit(" ")
    ).otherwise(number.cast("string"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        percent_score(text).alias("percent_score"),
        national_score(cell).alias("national_score"),
    )


def _national_facts(spark: SparkSession, folder: str) -> DataFrame:
    return national_rows(derived.national_lines(spark, folder))


def _regional_facts(spark: SparkSession, folder: str) -> DataFrame:
    return regional_rows(derived.regional_lines(spark, folder))


def _trend_facts(spark: SparkSession, folder: str) -> DataFrame:
    star = order_star(spark, folder)
    return raw_star.trend_facts(
        _national_facts(spark, folder),
        _regional_facts(spark, folder),
        derived.named_entities(spark, folder),
        star.regions,
        star.sources,
        THIRD_SOURCE,
    )


def _with_entity_name(rows: DataFrame, suffix: str) -> DataFrame:
    return rows.withColumn("entity_name", docs.entity_of_file(suffix))


def _news_events(spark: SparkSession, folder: str) -> DataFrame:
    """One body holds two articles, so the event id orders the bodies."""
    rows = docs.news_articles(derived.news_bodies(spark, folder))
    ordered = _with_entity_name(rows, docs.NEWS_SUFFIX).withColumn(
        "pos", F.col("event_id") * 2 + F.col("pos")
    )
    return raw_star.news_facts(ordered, derived.named_entities(spark, folder))


def _publication_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs.publications(derived.publication_bodies(spark, folder))
    ordered = _with_entity_name(rows, docs.PUBLICATION_SUFFIX).withColumn("pos", F.col("event_id"))
    return raw_star.publication_facts(
        ordered, derived.named_entities(spark, folder), date(2024, 1, 7), date(2024, 1, 27)
    )


def _pageview_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = docs.pageviews(derived.pageview_bodies(spark, folder))
    facts = raw_star.pageview_facts(
        _with_entity_name(rows, docs.PAGEVIEW_SUFFIX),
        derived.named_entities(spark, folder),
        order_star(spark, folder).sources,
        SECOND_SOURCE,
    )
    return facts.withColumn("interest_score", F.round("interest_score", 6))


def _populations(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").where(F.col("n_nationkey") < KNOWN_NATIONS)
    known = [row.n_name for row in nations.select("n_name").collect()]
    return docs.populations(derived.population_bodies(spark, folder), known)


def _sheet_populations(spark: SparkSession, folder: str) -> DataFrame:
    years = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    sheet = derived.population_sheet(spark, folder, sorted(row.year for row in years.collect()))
    places = places_from_sheet(sheet, derived.nation_codes(spark, folder))
    return docs.newest_population(places)


def _raw_star(spark: SparkSession, folder: str) -> Star:
    """The whole way of raw data: real exports, the star read from them, its tables handed
    on as CSV, and the star read from those. Entities are numbered, sources are authored."""
    target = scratch_path(spark, "exports")
    paths = raw_star.RawPaths(
        **derived.write_exports(spark, folder, f"{target}/raw"), bodies_per_line=True
    )
    ordered = order_star(spark, folder)
    number = F.row_number().over(Window.orderBy("entity_name"))  # a handful of rows
    numbered = materialised(ordered.entities.withColumn("entity_id", number), "entities")
    star = raw_star.raw_star(
        spark, paths, numbered, region_keys=ordered.regions.select("region_id", "region_name")
    )
    for name, rows in star.tables().items():
        save_processed(rows, f"{target}/processed/{name}")
    return Star.read(spark, f"{target}/processed", "csv")


def _on_raw_star(question: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: question(_raw_star(spark, folder))


def _sheet_from_file(spark: SparkSession, folder: str) -> DataFrame:
    years = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    cells = derived.write_sheet(
        spark, folder, sorted(row.year for row in years.collect()), scratch_path(spark, "sheet")
    )
    return docs.newest_population(
        places_from_sheet(with_header(cells), derived.nation_codes(spark, folder))
    )


def _missing_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores that are not a number when they are saved are missing when they are read."""
    score = F.when(F.col("date_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("interest_score"))
    rows = order_star(spark, folder).interest.withColumn("interest_score", score)
    target = f"{scratch_path(spark, 'missing')}/interest"
    reload_table(rows, target)
    return read_table(spark, *os.path.split(target)).groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("interest_score").isNull()).alias("n_missing"),
        F.count_if(F.isnan("interest_score")).alias("n_nan"),
    )


def _unresolved_names(spark: SparkSession, folder: str) -> DataFrame:
    """Event types and segments in mixed case against the segments."""
    names = table(spark, folder, "events").select(
        F.concat(F.lit(" "), F.upper("event_type")).alias("name")
    ).unionByName(
        table(spark, folder, "customer").select(F.lower("c_mktsegment").alias("name"))
    )
    return resolve.unresolved(names, "name", derived.named_entities(spark, folder), "entity_name")


def _sentence_titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", sentence_case(F.col("p_name")).alias("title")
    )


def _load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Load the star twice into the shared folder, hand the facts on as CSV, and count
    what is read back next to what the loader observed."""
    target = scratch_path(spark, "star")
    star = order_star(spark, folder)
    load_star(spark, star, target)
    observed = load_star(spark, star, target)
    loaded = Star.read(spark, target)
    save_processed(loaded.interest, f"{target}/processed/interest", "csv")
    handed = spark.read.csv(f"{target}/processed/interest", header=True, schema=loaded.interest.schema)
    seen = local_table(
        spark, sorted(observed.items()),
        spark.range(0).selectExpr("'' AS table_name", "id AS observed_rows").schema,
    )
    counts = coverage.row_counts({**loaded.tables(), "interest_csv": handed})
    return counts.join(seen, "table_name", "left").select(
        "table_name", "row_count", F.coalesce("observed_rows", "row_count").alias("observed_rows")
    )


def _load_rejects_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """What a load refuses, and why, when an entity of the facts is not in its dimension."""
    star = order_star(spark, folder)
    first = star.entities.agg(F.min("entity_id")).scalar()
    short = star.but(entities=star.entities.where(F.col("entity_id") != first))
    try:
        load_star(spark, short, scratch_path(spark, "orphans"))
    except quality.QualityError:
        reports = [quality.key_report(short.table(f), f, short.foreign_keys(f)) for f in FACTS]
        return reports[0].unionByName(reports[1]).where("n_bad > 0")
    raise AssertionError("facts without their entity were loaded")


def _refused_keeps_star(spark: SparkSession, folder: str) -> DataFrame:
    """The stored star after a load that was refused: the rows of each table as they were
    loaded first, and how many keys of the facts are not found."""
    target = scratch_path(spark, "refused")
    star = order_star(spark, folder)
    before = load_star(spark, star, target)
    first = star.entities.agg(F.min("entity_id")).scalar()
    try:
        load_star(spark, star.but(entities=star.entities.where(F.col("entity_id") != first)), target)
    except quality.QualityError:
        pass
    else:
        raise AssertionError("facts without their entity were loaded")
    stored = Star.read(spark, target)
    orphans = [
        quality.key_report(stored.table(f), f, stored.foreign_keys(f)).groupBy("table_name").agg(
            F.sum("n_bad").alias("n_orphans"))
        for f in FACTS
    ]
    loaded = local_table(
        spark, sorted(before.items()),
        spark.range(0).selectExpr("'' AS table_name", "id AS loaded_rows").schema,
    )
    counts = coverage.row_counts(stored.tables()).join(loaded, "table_name")
    return counts.join(orphans[0].unionByName(orphans[1]), "table_name", "left").select(
        "table_name", "row_count", "loaded_rows", F.coalesce("n_orphans", F.lit(0)).alias("n_orphans")
    )


def _stored_top_entity(spark: SparkSession, folder: str) -> DataFrame:
    """Growth per entity over a stored star, whose fact is partitioned by source: only
    that source's partition and the two windows are read."""
    target = scratch_path(spark, "stored")
    load_star(spark, order_star(spark, folder), target, partition_facts={"interest": ["source_id"]})
    return growth.entity_growth(Star.read(spark, target), FIRST_SOURCE)


def _streamed_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """The weeks that a stream over the events has closed, beside those still open, which
    a batch over the same files counts."""
    target = scratch_path(spark, "stream")
    schema = table(spark, folder, "events").schema
    stream = weekly.arriving(spark, folder, schema, "events.parquet")
    counts = weekly.weekly_counts(stream, "ts", ["event_type"], "value")
    weekly.append_closed_weeks(counts, f"{target}/weeks", f"{target}/mark").awaitTermination()
    closed = spark.read.schema(counts.schema).parquet(f"{target}/weeks")
    now = weekly.weekly_counts(table(spark, folder, "events"), "ts", ["event_type"], "value")
    still_open = now.join(closed, ["week", "event_type"], "left_anti")
    both = closed.withColumn("closed", F.lit(True)).unionByName(
        still_open.withColumn("closed", F.lit(False))
    )
    return both.withColumn("total", F.round("total", 2))


def _article_files(spark: SparkSession, folder: str, target: str, share: int) -> None:
    """Every third article, by position, as one delivery more of a folder: the files of all
    tasks, since one file would put all rows through one of them."""
    articles(spark, folder).where(F.col("pos") % 3 == share).write.mode("append").parquet(target)


def _incremental_events(spark: SparkSession, folder: str) -> DataFrame:
    """The rollup after articles came in three deliveries, two loads and a load without news."""
    target = scratch_path(spark, "incremental")
    raw = f"{target}/raw"

    def take() -> list[str]:
        found = spark.read.parquet(raw).select("*", incremental.input_name().alias("input"))
        return incremental.take_articles(spark, target, found)

    _article_files(spark, folder, raw, 0)
    take()
    for share in (1, 2):
        _article_files(spark, folder, raw, share)
    take()
    if take():
        raise AssertionError("inputs were taken twice")
    return incremental.rolled_up(spark, target)


def _streamed_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The streamed rollup over three deliveries that all touch the same weeks, each taken as
    it comes, beside the exact number of publishers."""
    target = scratch_path(spark, "stream-rollup")
    schema = articles(spark, folder).schema
    for share in range(3):
        _article_files(spark, folder, f"{target}/raw", share)
        stream = spark.readStream.schema(schema).parquet(f"{target}/raw")
        rollup.follow_articles(stream, target, f"{target}/mark").awaitTermination()
    exact = event_rollup(spark.read.schema(schema).parquet(f"{target}/raw"))
    keys = rollup.KEYS
    counted = exact.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("source_count").alias("exact"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    # Five standard errors.
    near = F.abs(F.col("source_count") - F.col("exact")) <= F.greatest(
        F.lit(0.5), F.col("exact") * 5 * rollup.SKETCH_ERROR)
    streamed = incremental.rolled_up(spark, target)
    return streamed.join(counted, reduce(Column.__and__, same)).select(
        *keys, "related_article_count", "title", near.alias("publishers_within_error"))


def _streamed_views(spark: SparkSession, folder: str) -> DataFrame:
    """The page-view index after its days came in three deliveries, the busiest ones last. Each
    is as many files as tasks made it, and is taken as it comes."""
    target = scratch_path(spark, "stream-views")
    rows = docs.pageviews(derived.pageview_bodies(spark, folder))
    named = raw_star.with_entity(
        _with_entity_name(rows, docs.PAGEVIEW_SUFFIX), derived.named_entities(spark, folder))
    daily = materialised(named.select("entity_id", "date", "views"), "daily-views")
    part = F.when(F.col("views") < 30, 0).when(F.col("views") < 60, 1).otherwise(2)
    for number in range(3):
        daily.where(part == number).write.mode("append").parquet(f"{target}/raw")
        stream = spark.readStream.schema(daily.schema).parquet(f"{target}/raw")
        pageviews.follow_views(stream, target, f"{target}/mark").awaitTermination()
    facts = pageviews.page_view_index(spark, target)
    return facts.select(
        date_key(F.col("date")).alias("date_id"), "entity_id",
        F.round("interest_score", 6).alias("interest_score"))


def _cube_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Growth and peak of each entity and the measure per million of each region, all from
    the cube."""
    star = order_star(spark, folder)
    made = cube.InterestCube.build(star.interest)

    def shown(rows: DataFrame, measure: str, name: str, *values: str) -> DataFrame:
        return rows.select(
            F.lit(measure).alias("measure"), F.col(name).alias("name"),
            *[F.col(v).cast("double").alias(f"value_{i}") for i, v in enumerate(values, 1)])

    parts = [
        shown(cube.entity_growth(made, star, FIRST_SOURCE), "growth", "entity_name",
              "baseline_avg", "current_avg", "growth_pct"),
        shown(cube.largest_spikes(made, star, FIRST_SOURCE), "peak", "entity_name",
              "peak_interest", "expected_interest", "spike_pct"),
        shown(cube.region_per_million(made, star), "per million", "region_name",
              "population", "raw_avg_interest", "interest_per_million_pop"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _rank_all_events(spark: SparkSession, folder: str) -> DataFrame:
    """The rank of every order by price, and of every event of the rollup by its articles."""
    orders = table(spark, folder, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").cast("string").alias("name"),
        F.col("o_totalprice").alias("value"))
    rolled = event_rollup(articles(spark, folder)).select(
        F.lit("event").alias("kind"),
        F.concat_ws("|", "entity_id", "event_date", F.coalesce(F.col("region_id").cast("string"), F.lit("-")),
                    "category").alias("name"),
        F.col("related_article_count").cast("double").alias("value"))
    parts = [ranking.ranked(rows, "value") for rows in (orders, rolled)]
    return parts[0].unionByName(parts[1])


QUERIES: dict[str, Query] = {
    # data quality
    "dq_row_counts": _on_star(lambda s: coverage.row_counts(s.tables())),
    "dq_null_region": _on_star(coverage.null_regions),
    "dq_null_rate_by_source": _on_star(coverage.null_region_rate),
    "dq_dup_interest": _on_star(
        lambda s: coverage.duplicates(s.interest, ["date_id", "entity_id", "region_id", "source_id"])
    ),
    "dq_dup_events": _on_star(
        lambda s: coverage.duplicates(s.events, ["event_date", "entity_id", "category", "title"])
    ),
    "dq_score_range": _on_star(distribution.score_range),
    "dq_null_profile": _on_star(lambda s: coverage.null_profile(s.tables())),
    "dq_report": _dq_report,
    "dq_unreadable": _dq_unreadable,
    "dq_publication_problems": _dq_problems,
    "src_places": _src_places,
    "src_authored_entities": _src_authored_entities,
    "dq_fk_offenders": _dq_fk_offenders,
    "dq_missing_authored": _dq_missing_authored,
    "dq_source_cap": _dq_at_cap,
    # dimension profiles
    "prof_entities": _on_star(coverage.entity_list),
    "prof_regions": _on_star(coverage.regions_by_population),
    "prof_sources": _prof_sources,
    "prof_date_range": _on_star(coverage.date_range),
    "prof_entity_coverage": _on_star(coverage.entity_coverage),
    "prof_region_coverage": _on_star(coverage.region_coverage),
    "prof_describe": lambda spark, folder: coverage.describe_columns(
        table(spark, folder, "customer"), ["c_nationkey", "c_mktsegment", "c_acctbal"]
    ),
    "prof_describe_wide": lambda spark, folder: profile.describe_wide(
        table(spark, folder, "documents")
    ),
    "prof_frequent_values": lambda spark, folder: profile.frequent_values(
        table(spark, folder, "documents"), FREQUENT_SHARE
    ),
    "prof_describe_entities": _on_star(
        lambda s: coverage.describe_columns(s.entities, ["primary_usage", "price_range", "approved"])
    ),
    "prof_describe_scores": _on_star(
        lambda s: coverage.describe_numbers(
            s.name_sources(s.interest), ["source_name"], "interest_score"
        )
    ),
    # distributions and trends
    "dist_score_by_source": _on_star(distribution.score_distribution),
    "dist_score_bracketed": _on_star(
        lambda s: distribution.score_distribution(s, accuracy=200)
    ),
    "dist_score_window": _score_window,
    "dist_histogram": _on_star(lambda s: distribution.score_histogram(s, 0.0, 500000.0, 20)),
    "trend_weekly": _on_star(distribution.weekly_trend),
    "bi_trend_line": _on_star(lambda s: distribution.weekly_trend(s, FIRST_SOURCE)),
    "growth_entity_source": _on_star(growth.entity_source_growth),
    # regions
    "regional_detail": _on_star(growth.regional_detail),
    "regional_growth": _on_star(lambda s: growth.region_growth(s, with_population=True)),
    "regional_per_million": _on_star(growth.region_per_million),
    "bi_per_million_total": _on_star(lambda s: growth.total_per_million(s, FIRST_SOURCE)),
    # across sources
    "cross_source_weekly": _on_star(
        lambda s: cross_source.side_by_side(s, FIRST_SOURCE, SECOND_SOURCE)
    ),
    "cross_source_pivot": _on_star(
        lambda s: cross_source.source_pivot(s, [FIRST_SOURCE, SECOND_SOURCE, THIRD_SOURCE])
    ),
    "cross_source_corr": _on_star(
        lambda s: cross_source.correlations(s, FIRST_SOURCE, SECOND_SOURCE)
    ),
    "source_agreement": _on_star(lambda s: cross_source.source_agreement(s, 90, 14)),
    # events
    "events_by_category": _on_star(events.by_category),
    "events_by_quarter": _on_star(events.by_quarter),
    "events_by_entity": _on_star(events.by_entity),
    "events_high_attention": _on_star(events.high_attention),
    "events_quarter_pivot": _on_star(events.quarter_pivot),
    "events_on_calendar": _events_on_calendar,
    "bi_events_year_quarter": _on_star(events.by_quarter_label),
    "bi_top_events": _on_star(events.most_reported),
    # KPIs
    "kpi_overall_growth": _on_star(lambda s: growth.overall_growth(s, FIRST_SOURCE)),
    "kpi_overall_growth_national": _on_star(
        lambda s: growth.overall_growth(s, FIRST_SOURCE, national_only=True)
    ),
    "kpi_yoy_growth": _on_star(lambda s: growth.year_over_year(s, FIRST_SOURCE)),
    "kpi_yoy_growth_complete": _on_star(
        lambda s: growth.year_over_year(s, FIRST_SOURCE, complete_years_only=True)
    ),
    "kpi_top_entity": _on_star(lambda s: growth.entity_growth(s, FIRST_SOURCE)),
    "kpi_top_entity_stored": _stored_top_entity,
    "kpi_top_region": _on_star(growth.region_growth),
    "kpi_largest_spike": _on_star(lambda s: spikes.largest_spikes(s, FIRST_SOURCE)),
    "kpi_event_lift": _on_lift(lift.event_lift),
    "kpi_event_attribution": _on_lift(lift.event_attribution),
    "kpi_event_attribution_by_entity": _on_lift(
        lambda interest, marks: lift.event_attribution(interest, marks, by_entity=True)
    ),
    "kpi_event_lift_daily": _daily_lift,
    "kpi_category_share": lambda spark, folder: ranking.category_share(
        table(spark, folder, "orders"), "o_orderpriority"
    ),
    "bi_peak_rank": _on_star(lambda s: spikes.peak_ranks(s, FIRST_SOURCE)),
    "bi_date_bounds": _on_star(lambda s: growth.reporting_bounds(s, FIRST_SOURCE)),
    "bi_top_growing": _on_star(lambda s: growth.top_growing(s, FIRST_SOURCE)),
    # sources, cleaning, facts, loading
    "cal_weeks": lambda spark, folder: order_star(spark, folder).dates,
    "cal_keys": _calendar_keys,
    "clean_scores": _clean_scores,
    "src_national_rows": _national_facts,
    "src_regional_rows": _regional_facts,
    "src_population": _populations,
    "src_population_sheet": _sheet_populations,
    "resolve_unknown_names": _unresolved_names,
    "text_sentence_case": _sentence_titles,
    "text_top_words": lambda spark, folder: titles.top_words(
        table(spark, folder, "documents"), "source", "text", "doc_id"
    ),
    "fact_trends": _trend_facts,
    "fact_pageviews": _pageview_index,
    "fact_news": _news_events,
    "fact_publications": _publication_events,
    "fact_event_rollup": lambda spark, folder: order_star(spark, folder).events,
    "raw_kpi_top_entity": _on_raw_star(lambda s: growth.entity_growth(s, ref.TREND_SOURCE)),
    "raw_interest_report": _on_raw_star(raw_star.interest_report),
    "raw_event_report": _on_raw_star(raw_star.event_report),
    "raw_events": _on_raw_star(lambda s: s.events),
    "raw_population_sheet": _sheet_from_file,
    "load_star_counts": _load_counts,
    "load_missing_scores": _missing_scores,
    "load_rejects_orphans": _load_rejects_orphans,
    "load_refused_keeps_star": _refused_keeps_star,
    "load_incremental_events": _incremental_events,
    "stream_event_rollup": _streamed_rollup,
    "stream_pageview_index": _streamed_views,
    "rank_all_events": _rank_all_events,
    "cube_measures": _cube_measures,
    "stream_weekly_events": _streamed_weeks,
}
