"""Interest as an additive cube: any slicer is answered from the smallest table that can."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.functions.calendar import key_to_date
from signalstar.functions.measures import growth_pct, per_million, rounded
from signalstar.operators.growth import WINDOW_DAYS, date_bounds, tag_period
from signalstar.plans.star import Star
from signalstar.session import scratch_path
from signalstar.sources.tables import write_observed

SLICERS = frozenset({"date_id", "entity_id", "region_id", "source_id"})
# The finest table and the coarser ones that reports ask for. Every table also tells regional
# rows from national ones, so none of them needs the region for that.
GROUPING_SETS = [
    SLICERS,
    frozenset({"date_id", "entity_id", "source_id"}),
    frozenset({"date_id", "region_id", "source_id"}),
    frozenset({"date_id", "source_id"}),
    frozenset({"entity_id", "source_id"}),
    frozenset({"region_id", "source_id"}),
    frozenset({"source_id"}),
]


@dataclass(frozen=True)
class Grouping:
    slicers: frozenset[str]
    cells: DataFrame
    rows: int


def _cells(rows: DataFrame, slicers: frozenset[str]) -> DataFrame:
    """What adds up: rows, scores, their sum, minimum and maximum."""
    return rows.groupBy(*sorted(slicers), "regional").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )


def _unit_cells(interest: DataFrame) -> DataFrame:
    score = F.col("interest_score")
    return interest.select(
        *sorted(SLICERS), F.col("region_id").isNotNull().alias("regional"),
        F.lit(1).cast("long").alias("rows"), score.isNotNull().cast("long").alias("n"),
        score.alias("total"), score.alias("low"), score.alias("high"),
    )


class InterestCube:
    """Sum, count, minimum and maximum of the score under several sets of slicers.

    Facts are read once, for the finest table; every other one is made from the smallest
    table that holds its slicers. Tables are stored, and their sizes are known from writing.
    """

    def __init__(self, groupings: list[Grouping]):
        self.groupings = groupings

    @classmethod
    def build(cls, interest: DataFrame, sets: list[frozenset[str]] | None = None) -> InterestCube:
        spark = interest.sparkSession
        made = cls([])
        for slicers in sorted(sets or GROUPING_SETS, key=len, reverse=True):
            finer = made.smallest(slicers).cells if made.groupings else _unit_cells(interest)
            path = scratch_path(spark, "cube")
            cells = _cells(finer, slicers)
            rows = write_observed(cells, path)["rows"]
            made.groupings.append(Grouping(slicers, spark.read.schema(cells.schema).parquet(path), rows))
        return made

    def smallest(self, slicers: frozenset[str] | set[str]) -> Grouping:
        able = [g for g in self.groupings if g.slicers >= set(slicers)]
        if not able:
            raise ValueError(f"no table of the cube has {sorted(slicers)}")
        return min(able, key=lambda g: (g.rows, len(g.slicers)))

    def cells(
        self, *slicers: str, star: Star | None = None, source: str | None = None,
        regional: bool | None = None,
    ) -> DataFrame:
        """Cells by the slicers asked for, of one source by name, of regional or national rows."""
        needed = {*slicers, *({"source_id"} if source is not None else ())}
        rows = self.smallest(needed).cells
        if source is not None:
            wanted = star.sources.where(F.col("source_name") == source).select("source_id")
            rows = rows.join(wanted, "source_id", "left_semi")
        if regional is not None:
            rows = rows.where(F.col("regional") == regional)
        return rows


def mean(condition: Column | None = None) -> Column:
    """The mean of the scores behind some cells."""
    total, n = F.col("total"), F.col("n")
    if condition is not None:
        total, n = F.when(condition, total), F.when(condition, n)
    return F.sum(total) / F.nullif(F.sum(n), F.lit(0))


def entity_growth(cube: InterestCube, star: Star, source: str, days: int = WINDOW_DAYS) -> DataFrame:
    """KPI 9.3 from the cube: the same windows over weekly cells."""
    rows = cube.cells("date_id", "entity_id", star=star, source=source)
    tagged = tag_period(rows, date_bounds(rows), days)
    grown = tagged.groupBy("entity_id").agg(
        mean(F.col("period") == "baseline").alias("baseline"),
        mean(F.col("period") == "current").alias("current"),
    )
    return star.name_entities(grown).select(
        "entity_name", rounded(F.col("baseline")).alias("baseline_avg"),
        rounded(F.col("current")).alias("current_avg"),
        rounded(growth_pct(F.col("current"), F.col("baseline"))).alias("growth_pct"),
    )


def largest_spikes(cube: InterestCube, star: Star, source: str) -> DataFrame:
    """KPI 9.5 from the cube: the latest of an entity's highest weeks against its mean."""
    peaks = cube.cells("date_id", "entity_id", star=star, source=source).groupBy("entity_id").agg(
        F.max(F.struct("high", "date_id")).alias("top"), mean().alias("expected"))
    return star.name_entities(peaks).select(
        "entity_name", key_to_date(F.col("top.date_id")).alias("peak_date"),
        F.col("top.high").alias("peak_interest"), rounded(F.col("expected")).alias("expected_interest"),
        rounded(growth_pct(F.col("top.high"), F.col("expected"))).alias("spike_pct"),
    )


def region_per_million(cube: InterestCube, star: Star) -> DataFrame:
    means = cube.cells("region_id", regional=True).groupBy("region_id").agg(mean().alias("mean"))
    return star.name_regions(means, "population").select(
        "region_name", "population", rounded(F.col("mean")).alias("raw_avg_interest"),
        rounded(per_million(F.col("mean"), F.col("population")), 4).alias("interest_per_million_pop"),
    )
