"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import stored

MAX_ROUNDS = 60  # far above the logarithm of any path; passing it is an error


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    return both.join(least, "u").where("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and itself, are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not its component's smallest.

    ``edges`` has columns u and v of one ordered type; direction, loops and repeats do not
    matter, and no edges give no rows. Only edges move between tasks, each round is written
    to the shared folder, and two numbers a round come to the driver.
    """
    edges = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    before = None
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "components")
        now = _state(edges)
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError("components did not settle")
