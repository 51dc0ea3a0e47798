"""A star over the order tables: what the registered queries run on.

entity    market segment of the ordering customer
region    region of the customer's nation, where a customer stands for a thousand people;
          orders of the two lowest priorities count as national rows and have none
source    order status
score     order value, dated by the Sunday of the order
events    user events rolled up per entity, week, region and event type, where a user is
          the customer of that number, the publisher is the user, and errors have no region
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.functions.calendar import date_key, week_start, weeks_between
from signalstar.operators.facts import event_rollup
from signalstar.plans.star import Star
from signalstar.sources.schemas import SOURCES
from signalstar.sources.tables import local_table

NATIONAL_PRIORITIES = ["4-NOT SPECIFIED", "5-LOW"]
UNPLACED_EVENT = "error"
PEOPLE_PER_CUSTOMER = 1000
# id, status letter, name, reliability
STATUS_SOURCES = [(1, "F", "Search trends", 7), (2, "O", "Page views", 6), (3, "P", "Bulletins", 9)]
FIRST_SOURCE, SECOND_SOURCE, THIRD_SOURCE = (name for _, _, name, _ in STATUS_SOURCES)


# The columns the queries use. A given schema saves the job that reads file footers.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def segment_name(segment: Column) -> Column:
    return F.initcap(F.lower(segment))


def status_source(status: Column) -> Column:
    picked = F.when(status == STATUS_SOURCES[0][1], STATUS_SOURCES[0][0])
    for number, letter, _, _ in STATUS_SOURCES[1:]:
        picked = picked.when(status == letter, number)
    return picked


def with_customer(spark: SparkSession, folder: str, rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with the segment and region of the customer in column ``key``.

    Customers and nations are joined one after the other and without a hint: Catalyst
    broadcasts each while its files are small, which it could not tell of their join,
    and beyond that shuffles by customer with skew splitting.
    """
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("entity_id")
    )
    nations = table(spark, folder, "nation").select(
        "n_nationkey", F.col("n_regionkey").alias("customer_region")
    )
    return (
        rows.join(customers, F.col(key) == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .drop("c_custkey", "c_nationkey", "n_nationkey")
    )


def entities(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    # Names are made after the aggregate, which then hashes and need not sort.
    rated = customers.groupBy(F.col("c_mktsegment").alias("entity_id")).agg(
        F.avg("c_acctbal").alias("balance")
    )
    return rated.select(
        "entity_id",
        segment_name(F.col("entity_id")).alias("entity_name"),
        F.concat(F.lit("buys "), F.lower("entity_id")).alias("primary_usage"),
        F.lit(None).cast("string").alias("price_range"),
        (F.col("balance") > 4500.0).alias("approved"),
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    people = (
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_regionkey").alias("region_id"))
        .agg((F.count(F.lit(1)) * PEOPLE_PER_CUSTOMER).alias("population"))
    )
    names = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")
    )
    return names.join(people, "region_id").select("region_id", "region_name", "population")


def sources(spark: SparkSession) -> DataFrame:
    return local_table(
        spark, [(n, name, score) for n, _, name, score in STATUS_SOURCES], SOURCES
    )


def dates(spark: SparkSession, folder: str) -> DataFrame:
    bounds = table(spark, folder, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return weeks_between(bounds, "first", "last")


def interest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice"
    )
    region = F.when(~F.col("o_orderpriority").isin(*NATIONAL_PRIORITIES), F.col("customer_region"))
    return with_customer(spark, folder, orders, "o_custkey").select(
        date_key(week_start(F.to_date("o_orderdate"))).alias("date_id"),
        "entity_id",
        region.alias("region_id"),
        status_source(F.col("o_orderstatus")).alias("source_id"),
        F.col("o_totalprice").alias("interest_score"),
    )


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """User events as articles: the user publishes, the event id orders by relevance."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "props")
    region = F.when(F.col("event_type") != UNPLACED_EVENT, F.col("customer_region"))
    return with_customer(spark, folder, events, "user_id").select(
        "entity_id",
        week_start(F.to_date("ts")).alias("week"),
        region.alias("region_id"),
        F.col("event_type").alias("category"),
        F.col("user_id").alias("publisher"),
        F.col("props").alias("title"),
        F.col("event_id").alias("pos"),
    )


def order_star(spark: SparkSession, folder: str) -> Star:
    return Star(
        entities=lambda: entities(spark, folder),
        regions=lambda: regions(spark, folder),
        sources=lambda: sources(spark),
        dates=lambda: dates(spark, folder),
        interest=lambda: interest(spark, folder),
        events=lambda: event_rollup(articles(spark, folder)),
    )
