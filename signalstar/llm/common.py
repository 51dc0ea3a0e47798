"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalstar.session import scratch_path

# The white space that counts as such: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def body(text: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_key(text: str) -> Column:
    """SHA-256 of the whole text: with the id it tells rows apart where ids repeat or are null."""
    return F.unhex(F.sha2(body(text).cast("binary"), 256))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Whether all of the columns are equal, null being a value like any other."""
    found = F.lit(True)
    for a, b in zip(left, right):
        found = found & F.col(a).eqNullSafe(F.col(b))
    return found


def first_rows(rows: DataFrame, keys: Sequence[str], quotas: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Of the rows with a key in ``quotas`` (``wanted`` and ``__quota``), as many as it says.

    Rows are numbered inside their input partition and partitions by running sums, so the
    rows of one key do not meet in a task.
    """
    parted = rows.withColumns(
        {"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}
    )
    some = stored(parted.join(quotas, same_keys(keys, wanted)).drop(*wanted), "first-rows")
    counts = some.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(
        *[F.col(c).alias(f"{c}_of") for c in (*keys, "__part")],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__ahead"),
    )
    place = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy("__row"))
    on = [*keys, "__part"]
    numbered = some.withColumn("__place", place).join(ahead, same_keys(on, [f"{c}_of" for c in on]))
    return numbered.where(F.col("__ahead") + F.col("__place") <= F.col("__quota")).select(*rows.columns)


CHUNK = 8 << 20  # bytes of text that a task works on at once


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    turn = np.cumsum(sizes, dtype=np.int64) // limit
    starts = [0, *(np.flatnonzero(np.diff(turn)) + 1), batch.num_rows]
    for a, b in zip(starts[:-1], starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
