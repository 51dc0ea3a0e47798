"""Names to ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Names match without regard to case or to blanks around them."""
    return F.upper(F.trim(name))


def resolve_ids(
    df: DataFrame, name: str, dim: DataFrame, dim_name: str, dim_id: str
) -> DataFrame:
    """``df`` with ``dim_id``; a name that is not in the dimension gets NULL, which the
    not-null check on the id then reports."""
    keys = dim.select(F.col(dim_id), name_key(F.col(dim_name)).alias("_name_key"))
    return df.join(keys, name_key(F.col(name)) == F.col("_name_key"), "left").drop("_name_key")


def unresolved(df: DataFrame, name: str, dim: DataFrame, dim_name: str) -> DataFrame:
    """Distinct names that the dimension does not know."""
    keys = dim.select(name_key(F.col(dim_name)).alias("_name_key"))
    seen = df.where(F.col(name).isNotNull()).select(
        F.col(name).alias("value"), name_key(F.col(name)).alias("_name_key")
    )
    return seen.distinct().join(keys, "_name_key", "left_anti").select("value")
