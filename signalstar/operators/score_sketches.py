"""Percentiles over any span of weeks from sketches that are made once, one for each week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.operators.percentiles import bracketed_percentiles

# Items that a sketch holds on its lowest level, and twice the share of the rows by which a
# rank of it may be off with 99 % confidence; sketches that are merged keep it.
SKETCH_K = 1024
RANK_ERROR = 0.006


def sketch_cells(rows: DataFrame, keys: list[str], week: str, value: str, k: int = SKETCH_K) -> DataFrame:
    """A mergeable sketch and the number of values of each (keys, week). To be stored: its size
    is that of the calendar, whatever the number of rows. Missing values do not count."""
    present = rows.where(F.col(value).isNotNull() & ~F.isnan(value))
    return present.groupBy(*keys, F.col(week).alias("week")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch")
    )


def _merged(cells: DataFrame, keys: list[str], first, last) -> DataFrame:
    span = cells.where(F.col("week").between(F.lit(first), F.lit(last)))
    return span.groupBy(*keys).agg(
        F.sum("n").alias("_n"), F.kll_merge_agg_double("sketch").alias("_sketch"))


def _at(share: float) -> Column:
    return F.kll_sketch_get_quantile_double("_sketch", F.lit(min(max(share, 0.0), 1.0)))


def span_quantiles(
    cells: DataFrame, keys: list[str], first, last, probs: dict[str, float]
) -> DataFrame:
    """Count and estimated percentiles of the weeks from ``first`` to ``last``, from the stored
    cells alone. A rank is off by no more than about ``RANK_ERROR`` of the rows."""
    merged = _merged(cells, keys, first, last)
    return merged.select(*keys, F.col("_n").alias("n"), *[_at(p).alias(name) for name, p in probs.items()])


def exact_span_quantiles(
    cells: DataFrame, rows: DataFrame, keys: list[str], week: str, value: str, first, last,
    probs: dict[str, float],
) -> DataFrame:
    """The same, exact: the cells bracket each rank, and one pass over the rows of the span
    counts what is below a bracket and puts in order only what is inside."""
    edges = [_at(p + side * RANK_ERROR) for p in probs.values() for side in (-1, 1)]
    sketch = _merged(cells, keys, first, last).select(*keys, "_n", F.array(*edges).alias("_edges"))
    present = rows.where(F.col(week).between(F.lit(first), F.lit(last)) & ~F.isnan(value))
    sketch = sketch.withColumn("n", F.col("_n"))
    return bracketed_percentiles(present, keys, value, probs, sketch, F.lit(False), ["n"])
