"""Tables that are replaced together or not at all.

Every load writes its tables into fresh folders. What readers see is named by a manifest, one
small file for each version that is written last and only where none is yet; the newest
counts. A load that fails or is killed before that leaves folders that no manifest names, and
the tables of the version before are as they were.

    <folder>/tables/<name>/<load>/…          rows
    <folder>/manifests/version=<n>/part-…    name, path, rows and load of every table
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "name string, path string, rows long, load string"


class StaleSnapshot(RuntimeError):
    """Another load was published while this one ran."""


@dataclass(frozen=True)
class Version:
    """Where a table of a snapshot is, relative to its folder, and how many rows it has."""

    name: str
    path: str
    rows: int


@dataclass(frozen=True)
class Snapshot:
    number: int
    tables: dict[str, Version]

    def with_tables(self, versions: list[Version]) -> Snapshot:
        return replace(self, tables={**self.tables, **{v.name: v for v in versions}})


NOTHING = Snapshot(0, {})


def _manifests(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{MANIFEST}, version long").json(f"{folder}/manifests")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def snapshots(spark: SparkSession, folder: str) -> list[Snapshot]:
    """All published versions, oldest first. Of two loads that published one number at the
    same moment the one whose name sorts first counts, for every reader."""
    found = _manifests(spark, folder)
    if found is None:
        return []
    # A few rows for each load.
    named: dict[int, dict[str, dict[str, Version]]] = {}
    for row in found.collect():
        loads = named.setdefault(row.version, {})
        loads.setdefault(row.load, {})[row.name] = Version(row.name, row.path, row.rows)
    return [Snapshot(number, named[number][min(named[number])]) for number in sorted(named)]


def current(spark: SparkSession, folder: str) -> Snapshot:
    """The newest version; one without tables where nothing has been published."""
    return (snapshots(spark, folder) or [NOTHING])[-1]


def read_version(spark: SparkSession, folder: str, snapshot: Snapshot, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{snapshot.tables[name].path}")


def new_load() -> str:
    return uuid.uuid4().hex


def version_path(name: str, load: str) -> str:
    return f"tables/{name}/{load}"


def publish(spark: SparkSession, folder: str, snapshot: Snapshot, load: str) -> Snapshot:
    """Make the tables of ``snapshot`` the newest version, if it is still the newest itself.

    A number whose file was begun but never finished is passed over.
    """
    rows = [(v.name, v.path, v.rows, load) for v in snapshot.tables.values()]
    number = snapshot.number
    while True:
        number += 1
        manifest = spark.createDataFrame(rows, MANIFEST).coalesce(1)
        try:
            manifest.write.mode("errorifexists").json(f"{folder}/manifests/version={number}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            taken = True
        else:
            taken = False
        newest = current(spark, folder)
        if taken and newest.number == snapshot.number:
            continue
        published = replace(snapshot, number=number)
        if newest != published:
            raise StaleSnapshot(f"{folder}: version {newest.number} was published meanwhile")
        return published


def retire(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Empty the folders that none of the ``keep`` newest versions names, and return them.

    Readers of the kept versions are not disturbed. Only folders of published versions are
    known; those of failed loads are found by what is not in any manifest.
    """
    every = snapshots(spark, folder)
    kept = {v.path for s in every[-keep:] for v in s.tables.values()}
    gone = sorted({v.path for s in every for v in s.tables.values()} - kept)
    for path in gone:
        spark.range(0).write.mode("overwrite").parquet(f"{folder}/{path}")
    return gone


def orphaned_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of row files that no version names, one row for each folder of a load."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet"
    ).load(f"{folder}/tables")
    path = F.regexp_extract("path", r"(tables/[^/]+/(?:load=)?[0-9a-f]{32})/", 1).alias("path")
    named = _manifests(spark, folder)
    folders = files.select(path).distinct()
    return folders if named is None else folders.join(named.select("path"), "path", "left_anti")
