"""A wide population sheet (one column per year) to one row per place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Header cells and the prefix of the year columns.
CODE_HEADER = "Code"
NAME_HEADER = "Name"
YEAR_PREFIX = "Mid-"


def with_header(cells: DataFrame) -> DataFrame:
    """Name the columns of a header-less sheet after its ``Code, Name, …`` row.

    The one header row is all that reaches the driver. Rows above it and the header
    itself have no place code, so the join to a code list drops them.
    """
    first, second = cells.columns[:2]
    header = cells.where(
        (F.col(first) == CODE_HEADER) & (F.col(second) == NAME_HEADER)
    ).first()
    if header is None:
        raise ValueError(f"no row begins with {CODE_HEADER}, {NAME_HEADER}")
    names = [header[c] or c for c in cells.columns]
    return cells.toDF(*names).where(F.col(CODE_HEADER).isNotNull())


def unpivot_years(sheet: DataFrame) -> DataFrame:
    """``code, year, population`` for every ``Mid-YYYY`` column."""
    years = [c for c in sheet.columns if c.startswith(YEAR_PREFIX)]
    numbers = sheet.select(
        F.col(CODE_HEADER).alias("code"),
        *[F.col(f"`{c}`").try_cast("bigint").alias(c.removeprefix(YEAR_PREFIX)) for c in years],
    )
    wanted = [c.removeprefix(YEAR_PREFIX) for c in years]
    return numbers.unpivot(["code"], wanted, "year", "population")


def places_from_sheet(sheet: DataFrame, codes: DataFrame) -> DataFrame:
    """``code, name, population_by_year`` for the places of a code list.

    A place has one entry per sheet column, so the collected map is bounded by the
    width of the sheet.
    """
    listed = unpivot_years(sheet).join(codes.select("code", "name"), "code")
    return listed.groupBy("code", "name").agg(
        F.map_from_entries(F.collect_list(F.struct("year", "population"))).alias(
            "population_by_year"
        )
    )
