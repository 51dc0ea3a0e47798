"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.sources.tables import local_table

# A side of this many short rows is a few megabytes at most.
MAX_BROADCAST_ROWS = 20_000


def measured(side: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``(side, fits)`` for a side that an aggregate made small.

    Catalyst knows the size of files but not of an aggregate, so it would shuffle the
    large side of the join. Here the side is computed once, at most ``max_rows + 1``
    rows of it: if it fits, it comes back as a local relation and need not be computed
    again; if not, it comes back untouched for a shuffled join, whose skew AQE splits.
    """
    rows = side.take(max_rows + 1)
    if len(rows) > max_rows:
        return side, False
    return local_table(side.sparkSession, rows, side.schema), True


def join_measured(
    big: DataFrame, side: DataFrame, on, how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Join ``big`` to an aggregated side, broadcasting it only when it proved small."""
    side, fits = measured(side, max_rows)
    return big.join(F.broadcast(side) if fits else side, on, how)
