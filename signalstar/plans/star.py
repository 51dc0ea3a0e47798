"""The star every query works on: four dimensions, two facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.operators.quality import ForeignKey
from signalstar.operators.sizing import join_measured
from signalstar.sources.schemas import TABLES
from signalstar.sources.snapshots import NOTHING, Snapshot, current, read_version
from signalstar.sources.tables import read_table

Table = DataFrame | Callable[[], DataFrame]


class Star:
    """
    entities  entity_id, entity_name, primary_usage, price_range, approved
    regions   region_id, region_name, population
    sources   source_id, source_name, reliability
    dates     date_id, date, month, quarter, year
    interest  date_id, entity_id, region_id (nullable), source_id, interest_score
    events    event_date, related_article_count, source_count, category, title,
              region_id (nullable), entity_id

    Keys may be of any type, but ``date_id`` is the yyyymmdd integer of a week start.
    A table may be given as a function; it is called when the table is first used.
    """

    def __init__(self, **tables: Table):
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise ValueError(f"not tables of a star: {sorted(unknown)}")
        self._tables = dict(tables)

    def table(self, name: str) -> DataFrame:
        found = self._tables[name]
        if callable(found):
            found = self._tables[name] = found()
        return found

    @property
    def entities(self) -> DataFrame:
        return self.table("entities")

    @property
    def regions(self) -> DataFrame:
        return self.table("regions")

    @property
    def sources(self) -> DataFrame:
        return self.table("sources")

    @property
    def dates(self) -> DataFrame:
        return self.table("dates")

    @property
    def interest(self) -> DataFrame:
        return self.table("interest")

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    @classmethod
    def of(cls, names: dict[str, str] | None = None, **tables: DataFrame) -> "Star":
        """A star from tables whose columns go by other names (``{theirs: ours}``)."""
        names = names or {}
        return cls(**{k: t.withColumnsRenamed(names) for k, t in tables.items()})

    @classmethod
    def of_snapshot(cls, spark: SparkSession, folder: str, snapshot: Snapshot) -> "Star":
        """The tables of one version, whatever is published later."""
        return cls(
            **{
                name: (lambda name=name: read_version(spark, folder, snapshot, name))
                for name in TABLES if name in snapshot.tables
            }
        )

    @classmethod
    def read(cls, spark: SparkSession, folder: str, file_format: str = "parquet") -> "Star":
        """The newest published version, or plain tables where none is. All tables are of the
        version found now."""
        snapshot = current(spark, folder) if file_format == "parquet" else NOTHING
        if snapshot.tables:
            return cls.of_snapshot(spark, folder, snapshot)
        return cls(
            **{
                name: (lambda name=name: read_table(spark, folder, name, file_format))
                for name in TABLES
            }
        )

    def but(self, **tables: Table) -> "Star":
        """The same star with some tables exchanged."""
        return Star(**{**self._tables, **tables})

    def foreign_keys(self, fact: str) -> list[ForeignKey]:
        """The keys that rows of a fact must find in the dimensions."""
        parents = {"date_id": "dates", "entity_id": "entities", "region_id": "regions",
                   "source_id": "sources"}
        columns = self.table(fact).columns
        return [ForeignKey(k, self.table(d), k) for k, d in parents.items() if k in columns]

    def names(self) -> list[str]:
        """The tables it has, dimensions first."""
        return [name for name in TABLES if name in self._tables]

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES if name in self._tables}

    def interest_of(
        self,
        source: str | None = None,
        regional: bool = False,
        national_only: bool = False,
    ) -> DataFrame:
        """Interest rows of one source by name, of any region, or of none.

        The source filter is a semi-join on the tiny source table, so no source
        column is added and a fact partitioned by source is pruned at run time.
        """
        rows = self.interest
        if source is not None:
            wanted = self.sources.where(F.col("source_name") == source).select("source_id")
            rows = rows.join(wanted, "source_id", "left_semi")
        if regional:
            rows = rows.where(F.col("region_id").isNotNull())
        if national_only:
            rows = rows.where(F.col("region_id").isNull())
        return rows

    # Names are joined after aggregating, when few rows are left. Where a query keeps
    # fact rows, ``many`` measures the dimension first: it may be an aggregate, whose
    # size Catalyst cannot know, and a shuffle by a dimension key would put all rows of
    # a hot member in one task.

    def name_entities(self, rows: DataFrame, many: bool = False) -> DataFrame:
        """Swap ``entity_id`` for the name."""
        return _swap(rows, self.entities.select("entity_id", "entity_name"), "entity_id", many)

    def name_sources(self, rows: DataFrame, many: bool = False) -> DataFrame:
        return _swap(rows, self.sources.select("source_id", "source_name"), "source_id", many)

    def name_regions(self, rows: DataFrame, *more: str, many: bool = False) -> DataFrame:
        return _swap(
            rows, self.regions.select("region_id", "region_name", *more), "region_id", many
        )


def _swap(rows: DataFrame, dim: DataFrame, key: str, many: bool) -> DataFrame:
    joined = join_measured(rows, dim, key) if many else rows.join(dim, key)
    return joined.drop(key)
