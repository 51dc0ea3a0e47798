"""The weekly event rollup as a stream that corrects weeks instead of refusing late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalstar.operators.facts import EVENT_COLUMNS
from signalstar.plans.incremental import overwrite_weeks, week_part

KEYS = ["entity_id", "event_date", "region_id", "category"]
# Publishers are counted by sketches of 2**14 registers, with a relative standard error of
# about 0.65 %; small counts are exact.
SKETCH_BITS = 14
SKETCH_ERROR = 0.0065


def rollup_states(articles: DataFrame) -> DataFrame:
    """What a batch knows of each event, in a form that can be merged with other batches:
    a count, a sketch of the publishers, and the title with the smallest position."""
    titled = F.when(F.col("title").isNotNull(), F.struct("pos", "title"))
    return articles.withColumnRenamed("week", "event_date").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("articles"),
        F.hll_sketch_agg(F.col("publisher").cast("string"), F.lit(SKETCH_BITS)).alias("publishers"),
        F.min(titled).alias("first"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """The events that any number of states add up to."""
    merged = states.groupBy(*KEYS).agg(
        F.sum("articles").alias("related_article_count"),
        F.hll_sketch_estimate(F.hll_union_agg("publishers")).alias("source_count"),
        F.min("first").alias("first"),
    )
    return merged.withColumn("title", F.col("first.title")).select(*EVENT_COLUMNS)


def merge_batch(articles: DataFrame, batch: int, folder: str) -> None:
    """Keep the states of a batch and make the weeks it touches anew from all states of them.

    The states of a batch have a folder of their own, which a repeated batch writes again, so
    no row counts twice. A week is never closed: a row that comes late changes its week then.
    """
    spark = articles.sparkSession
    path = f"{folder}/states"
    states = rollup_states(articles).withColumn("part", week_part("event_date"))
    states.write.mode("overwrite").partitionBy("part").parquet(f"{path}/batch={batch}")
    kinds = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in states.schema)}, batch long"
    every = spark.read.schema(kinds).parquet(path)
    # No more values than the calendar has weeks; only folder names are read.
    weeks = [r.part for r in every.where(F.col("batch") == batch).select("part").distinct().collect()]
    if weeks:
        overwrite_weeks(merged_states(every.where(F.col("part").isin(weeks))), f"{folder}/events", "event_date")


def follow_articles(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Merge what has arrived; the rollup is then in ``<folder>/events``. One checkpoint goes
    with one folder."""
    return (
        stream.writeStream.foreachBatch(lambda rows, batch: merge_batch(rows, batch, folder))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
