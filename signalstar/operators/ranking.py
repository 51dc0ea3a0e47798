"""Competition ranks over a whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstar.functions.measures import rounded, share_pct
from signalstar.operators.sizing import join_measured
from signalstar.sources.tables import local_table, materialised


def value_ranks(df: DataFrame, value: str, top: int | None = None) -> DataFrame:
    """The rank of each distinct value, largest first, NULL last; ties share a rank.

    A rank is one more than the number of rows with a larger value, so only value
    counts need an order. With ``top`` no more than that many values are looked at, in one
    task; without it they are spread by :func:`spread_ranks`.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    if top is None:
        return spread_ranks(counts, value, "_c")
    counts = counts.orderBy(F.desc_nulls_last(value)).limit(top)
    above = F.coalesce(
        F.sum("_c").over(
            Window.orderBy(F.desc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    ranks = counts.select(value, (above + 1).cast("bigint").alias("rank"))
    return ranks.where(F.col("rank") <= top)


def spread_ranks(counts: DataFrame, value: str, count: str) -> DataFrame:
    """``value, rank`` of distinct values with their row counts, however many there are.

    Values are dealt into ranges, one partition each. A rank is the rows in the ranges above,
    a running sum over one number for each partition, and those above it in its own range.
    """
    spark = counts.sparkSession
    order = F.desc_nulls_last(value)
    ranged = materialised(
        counts.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranks")
    totals = ranged.groupBy("_range").agg(F.sum(count).alias("_n")).collect()
    ahead, rows = 0, []
    for row in sorted(totals, key=lambda r: r._range):
        rows.append((row._range, ahead))
        ahead += row._n
    offsets = local_table(spark, rows, T.StructType([
        T.StructField("_range", T.IntegerType()), T.StructField("_ahead", T.LongType())]))
    within = F.sum(count).over(
        Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.withColumn("_above", F.coalesce(within, F.lit(0)))
    return placed.join(F.broadcast(offsets), "_range").select(
        value, (F.col("_ahead") + F.col("_above") + 1).cast("bigint").alias("rank"))


def ranked(df: DataFrame, value: str) -> DataFrame:
    """Every row with its competition rank by ``value``, largest first, NULL last."""
    ranks = value_ranks(df, value).withColumnRenamed(value, "_value")
    joined = df.join(ranks, F.col(value).eqNullSafe(F.col("_value")))
    return joined.select(*df.columns, "rank")


def top_ranked(df: DataFrame, value: str, top: int) -> DataFrame:
    """All rows of rank ``top`` or better, with their rank; every tie at the cut stays."""
    ranks = value_ranks(df.where(F.col(value).isNotNull()), value, top)
    return df.join(F.broadcast(ranks), value)


def category_share(df: DataFrame, column: str) -> DataFrame:
    """KPI 9.8 for any category column: count, share of all rows and rank.

    Distinct counts that sum to the number of rows are few, so ordering them takes one task
    however many categories there are.
    """
    present = df.where(F.col(column).isNotNull())
    counts = present.groupBy(F.col(column).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    total = present.agg(F.count(F.lit(1)).alias("total")).scalar()
    above = F.coalesce(F.sum("_c").over(
        Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = counts.groupBy("n").agg(F.count(F.lit(1)).alias("_c")).select(
        "n", (above + 1).cast("bigint").alias("rank"))
    return join_measured(counts, ranks, "n").select(
        "category", "n", rounded(share_pct(F.col("n"), total)).alias("share_pct"), "rank"
    ).orderBy("rank", "category")
