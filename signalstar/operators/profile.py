"""Profiles of wide tables: top values, frequencies and heavy hitters without moving values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.sources.tables import materialised

WINNERS = 1000  # most frequent values a column may have for their digests to be broadcast


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value) of every cell that is not null."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], columns, "column_name", "value").where("value is not null")


def _digest() -> Column:
    """128 bits that stand for a value when it is counted."""
    return F.unhex(F.md5("value"))


def describe_wide(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its count for each column.

    The same answer as ``coverage.describe_columns`` for columns with very many or very long
    values. Values are counted by digests of sixteen bytes, once, for the distinct count; the
    values themselves never move. The most frequent value is the smallest of those with the
    highest count: where that count is one it is the column's minimum; else the winners'
    digests meet the rows again. Beyond WINNERS of them, that many drawn by digest give a value
    that the smallest winner cannot exceed, and only cells up to it are put to the join.
    Columns without a value get zero counts; an empty table does too.
    """
    columns = columns or df.columns
    spark = df.sparkSession
    counted = materialised(
        _cells(df, columns).groupBy("column_name", _digest().alias("digest"))
        .agg(F.count(F.lit(1)).alias("n")),
        "digests",
    )
    sizes = counted.groupBy("column_name", "n").agg(F.count(F.lit(1)).alias("having")).groupBy(
        "column_name"
    ).agg(
        F.sum(F.col("n") * F.col("having")).alias("n_values"), F.sum("having").alias("n_unique"),
        F.max(F.struct("n", "having")).alias("most"),
    ).collect()  # one row a column
    known = {r.column_name: r for r in sizes}
    single = [c for c, r in known.items() if r.most.n == 1]
    few = [c for c, r in known.items() if r.most.n > 1 and r.most.having <= WINNERS]
    many = [c for c, r in known.items() if r.most.n > 1 and r.most.having > WINNERS]
    least: dict[str, str] = {}

    def smallest(cells: DataFrame) -> None:
        least.update(cells.groupBy("column_name").agg(F.min("value").alias("v")).collect())

    def winners(names: list[str]) -> DataFrame:
        won = F.lit(False)
        for c in names:
            won = won | ((F.col("column_name") == c) & (F.col("n") == known[c].most.n))
        return counted.where(won).select(F.col("column_name").alias("of"), F.col("digest").alias("won"))

    met = (F.col("column_name") == F.col("of")) & (_digest() == F.col("won"))
    if single:
        smallest(_cells(df, single))
    if few:
        smallest(_cells(df, few).join(F.broadcast(winners(few)), met, "left_semi"))
    if many:
        drawn = [winners([c]).orderBy("won").limit(WINNERS) for c in many]
        for c, some in zip(many, drawn):
            smallest(_cells(df, [c]).join(F.broadcast(some), met, "left_semi"))
        bound = F.lit(False)
        for c in many:
            bound = bound | ((F.col("column_name") == c) & (F.col("value") <= least[c]))
        low = _cells(df, many).where(bound)
        smallest(low.join(winners(many), met, "left_semi"))
    rows = [
        (c, known[c].n_values, known[c].n_unique, least[c], known[c].most.n) if c in known
        else (c, 0, 0, None, None)
        for c in columns
    ]
    return spark.createDataFrame(
        rows, "column_name string, n_values long, n_unique long, top string, freq long"
    )


def frequent_values(df: DataFrame, share: float, columns: list[str] | None = None) -> DataFrame:
    """Every value that fills at least ``share`` of its column's non-null cells: column_name,
    value, n, n_values.

    A first pass keeps one frequent-items sketch a column, whose size depends on ``share``
    alone and which holds every hash of such a share (its error is a third of it at most); a
    second pass counts the cells of those hashes by whole value. No shuffle grows with the
    number of distinct values.
    """
    columns = columns or df.columns
    tracked = math.ceil(16 / share)
    hashed = df.select(*[
        F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c).cast("string"))).alias(c) for c in columns
    ])
    first = hashed.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.expr(f"approx_top_k(`{c}`, {tracked}, {tracked})").alias(f"k{i}") for i, c in enumerate(columns)],
    ).first()
    held = [
        (c, item.item, first[f"n{i}"]) for i, c in enumerate(columns)
        for item in first[f"k{i}"] or [] if item.item is not None
    ]
    likely = df.sparkSession.createDataFrame(held, "of string, hash long, n_values long")
    cells = _cells(df, columns).join(
        F.broadcast(likely),  # at most 16 / share rows a column
        (F.col("column_name") == F.col("of")) & (F.xxhash64("value") == F.col("hash")),
    )
    return cells.groupBy("column_name", "value", "n_values").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= F.lit(share) * F.col("n_values")
    ).select("column_name", "value", "n", "n_values")
