"""The event rollup kept up to date from inputs as they come: only changed weeks are made anew.

    <folder>/tables/staged/load=<load>/part=<week>/…   article rows of each load
    <folder>/tables/inputs/<load>/…                    names of all inputs taken so far
    <folder>/manifests/…                               what of it counts, see sources/snapshots.py
    <folder>/events/part=<week>/…                      the rollup
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstar.operators.facts import EVENT_COLUMNS, event_rollup
from signalstar.sources import snapshots
from signalstar.sources.snapshots import Version
from signalstar.sources.tables import write_observed

ARTICLE_COLUMNS = ["entity_id", "week", "region_id", "category", "publisher", "title", "pos"]
NO_WEEK = "none"
STAGED = "tables/staged"


def input_name() -> Column:
    """A file with its time of change: one that is written again is another input."""
    changed = F.unix_micros(F.col("_metadata.file_modification_time"))
    return F.concat_ws("@", "_metadata.file_path", changed.cast("string"))


def week_part(week: str) -> Column:
    """The folder of a week; rows whose week is unknown have one as well."""
    return F.coalesce(F.col(week).cast("string"), F.lit(NO_WEEK))


def overwrite_weeks(rows: DataFrame, path: str, week: str) -> None:
    """Replace the weeks that ``rows`` hold and leave all others."""
    parted = rows.withColumn("part", week_part(week))
    parted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "part").parquet(path)


def _inputs(spark: SparkSession, folder: str, snapshot: snapshots.Snapshot) -> DataFrame:
    if "inputs" not in snapshot.tables:
        return spark.createDataFrame([], "input string")
    return snapshots.read_version(spark, folder, snapshot, "inputs")


def take_articles(spark: SparkSession, folder: str, articles: DataFrame) -> list[str]:
    """Take the articles of inputs that are new, and return the weeks that were made anew.

    ``articles`` has the columns of :func:`event_rollup` and ``input``, the name of the input a
    row is from. Rows of new inputs are staged by week and published together with the names
    of their inputs, so that an input counts once and whole. Then the weeks of staged loads
    that are not rolled up yet are aggregated from all staged rows of those weeks, and replace
    the old ones. A run that is lost is simply run again: what it staged without publishing is
    not read, and weeks it did not finish are found and made then. One writer at a time; of
    two, the later to publish is refused.
    """
    base, load = snapshots.current(spark, folder), snapshots.new_load()
    taken = _inputs(spark, folder, base)
    fresh = articles.join(taken, "input", "left_anti").select(*ARTICLE_COLUMNS, "input")
    staged, inputs = f"{STAGED}/load={load}", snapshots.version_path("inputs", load)
    rows = write_observed(
        fresh.withColumn("part", week_part("week")), f"{folder}/{staged}", ["part"])["rows"]
    folders = [T.StructField(n, T.StringType()) for n in ("load", "part")]
    kinds = T.StructType([*fresh.schema.fields, *folders])

    def read(paths: list[str]) -> DataFrame:
        reader = spark.read.schema(kinds).option("basePath", f"{folder}/{STAGED}")
        return reader.parquet(*[f"{folder}/{p}" for p in paths])

    if rows:
        names = taken.unionByName(read([staged]).select("input").distinct())
        n = write_observed(names, f"{folder}/{inputs}")["rows"]
        base = snapshots.publish(spark, folder, base.with_tables([
            Version(f"staged/{load}", staged, rows), Version("inputs", inputs, n)]), load)
    loads = {n.removeprefix("staged/"): v.path for n, v in base.tables.items() if n.startswith("staged/")}
    waiting = {n: p for n, p in loads.items() if f"rolled/{n}" not in base.tables}
    if not waiting:
        return []
    # No more values than the calendar has weeks; only folder names are read.
    weeks = sorted(r.part for r in read(list(waiting.values())).select("part").distinct().collect())
    changed = read(list(loads.values())).where(F.col("part").isin(weeks))
    overwrite_weeks(event_rollup(changed), f"{folder}/events", "event_date")
    done = [Version(f"rolled/{n}", p, 0) for n, p in waiting.items()]
    snapshots.publish(spark, folder, base.with_tables(done), snapshots.new_load())
    return weeks


def rolled_up(spark: SparkSession, folder: str) -> DataFrame:
    """The rollup as it now stands."""
    return spark.read.parquet(f"{folder}/events").select(*EVENT_COLUMNS)
