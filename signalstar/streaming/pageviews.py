"""The page-view index as a stream: weekly totals, and each entity's share of its own peak."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalstar.operators.facts import own_peak_index, weekly_totals

BUCKETS = 64  # folders that entities are dealt into


def _bucket() -> Column:
    return F.pmod(F.xxhash64("entity_id"), F.lit(BUCKETS)).cast("int")


def _overwrite(rows: DataFrame, path: str, *by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def merge_views(daily: DataFrame, batch: int, folder: str) -> None:
    """Add a batch of ``entity_id, date, views`` to the index in ``<folder>/index``.

    There are two levels of state. ``totals`` has the sums of each batch by entity and week, in
    folders of their own that a repeated batch writes again. ``index`` has each entity's weeks
    as percent of its peak so far. A new total changes its week, and if it is a new peak all
    weeks of that entity, which are no more than the calendar has; so the buckets that hold
    entities of the batch are made anew from their totals, and no others are read.
    """
    spark = daily.sparkSession
    sums = weekly_totals(daily, "date", "views").withColumn("bucket", _bucket())
    sums.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/totals/batch={batch}")
    kinds = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in sums.schema)}, batch long"
    every = spark.read.schema(kinds).parquet(f"{folder}/totals")
    # At most BUCKETS values, from folder names.
    touched = [r.bucket for r in every.where(F.col("batch") == batch).select("bucket").distinct().collect()]
    if not touched:
        return
    totals = every.where(F.col("bucket").isin(touched)).groupBy("entity_id", "date", "bucket").agg(
        F.sum("weekly_total").alias("weekly_total"))
    _overwrite(own_peak_index(totals), f"{folder}/index", "bucket")


def page_view_index(spark: SparkSession, folder: str) -> DataFrame:
    """``entity_id, date, weekly_total, interest_score`` as they now stand."""
    return spark.read.parquet(f"{folder}/index").drop("bucket")


def follow_views(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Add what has arrived. Late days change their weeks; one checkpoint goes with one folder."""
    return (
        stream.writeStream.foreachBatch(lambda rows, batch: merge_views(rows, batch, folder))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
