"""Weekly event counts as a stream, with the Sunday weeks of the batch rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalstar.functions.calendar import week_start


def arriving(
    spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet"
) -> DataFrame:
    """Parquet files of a folder, each picked up once."""
    return spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(folder)


def weekly_counts(
    stream: DataFrame, stamp: str, keys: list[str], value: str, late: str = "14 days"
) -> DataFrame:
    """Rows and value sum per key and week.

    The event time is the week start itself, so weeks begin on Sunday in any time zone.
    A week is closed once a week start more than ``late`` after it has been seen, which
    bounds the state.
    """
    weeks = stream.withColumn(
        "_week", week_start(F.to_date(stamp)).cast("timestamp")
    ).withWatermark("_week", late)
    return weeks.groupBy("_week", *keys).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total")
    ).select(F.to_date("_week").alias("week"), *keys, "n_events", "total")


def append_closed_weeks(counts: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Each week is written once, when its watermark has passed; weeks still open stay
    in the state for the next run. The sink commits a batch whole or not at all."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_groups(query: StreamingQuery) -> int:
    """How many (week, key) groups came too late in the batches of a run, by the query's own
    progress. Their week was written before, so they are in no total; a run that finds some
    should be followed by a batch count of those weeks."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
