"""Finished tables on disk: typed scans, and full reloads that report their row count."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from signalstar.functions.cleaning import nan_to_null
from signalstar.session import scratch_path
from signalstar.sources import snapshots
from signalstar.sources.schemas import TABLES


def export_name() -> Column:
    """The name of the export that a scanned row belongs to: its file, or for the part files
    of a large export the folder they are in, plain or as a partition (``name=…``)."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    file = F.col("_metadata.file_name")
    return F.when(
        file.startswith("part-"), F.regexp_replace(folder, "^[a-z_]+=", "")
    ).otherwise(file)


def read_table(
    spark: SparkSession, folder: str, name: str, file_format: str = "parquet"
) -> DataFrame:
    """One of the six tables; CSV is read with the table's schema, never inferred. Of a folder
    with published versions the newest one is read."""
    path = f"{folder}/{name}"
    if file_format == "csv":
        return spark.read.schema(TABLES[name]).csv(path, header=True, escape='"')
    snapshot = snapshots.current(spark, folder)
    if name in snapshot.tables:
        return snapshots.read_version(spark, folder, snapshot, name)
    return spark.read.format(file_format).load(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Authored rows as a relation whose exact size Catalyst knows, so that a join to
    it is broadcast. (A frame made straight from Python rows has no known size and
    would be shuffled together with the fact table.)"""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow))


def nans_to_nulls(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL in a finished table, never NaN."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            nan_to_null(F.col(c)).alias(c)
            if isinstance(kinds[c], (T.DoubleType, T.FloatType))
            else F.col(c)
            for c in df.columns
        ]
    )


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Rows that a query needs more than once, written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_processed(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """A hand-off file set: folders are made, CSV gets a header."""
    writer = nans_to_nulls(df).write.mode("overwrite").format(file_format)
    if file_format == "csv":
        # Quotes are doubled, as other tools expect.
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)


def write_observed(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    metrics: list[Column] | None = None,
) -> dict:
    """Write a table to a fresh path. Returns ``rows`` and the named metrics, which are
    observed while the rows are written, so that no second job computes them.

    ``sort_by`` orders the rows inside each file without a shuffle, which lets a later filter
    skip row groups.
    """
    seen = Observation()
    rows = nans_to_nulls(df).observe(seen, F.count(F.lit(1)).alias("rows"), *(metrics or []))
    if sort_by:
        rows = rows.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = rows.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return {"rows": 0, **seen.get}  # no rows, no counters


def reload_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> int:
    """Replace a table and return its row count.

    Rows are written to a folder of their own and become the table once they are complete, by
    a new version of the tables of the folder above: a job that fails leaves the old rows, a
    table may be made from itself, and a rerun gives the same table. Read it by
    :func:`read_table`.
    """
    spark = df.sparkSession
    folder, name = os.path.split(path.rstrip("/"))
    base, load = snapshots.current(spark, folder), snapshots.new_load()
    fresh = snapshots.version_path(name, load)
    rows = write_observed(df, f"{folder}/{fresh}", partition_by, sort_by)["rows"]
    snapshots.publish(spark, folder, base.with_tables([snapshots.Version(name, fresh, rows)]), load)
    return rows
