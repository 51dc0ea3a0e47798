"""Exact continuous percentiles of groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstar.operators.sizing import measured

# Relative precision of the quantile sketch. A group that the sketch holds whole is put in
# order whole; of a larger one only a small bracket around each rank is.
ACCURACY = 100_000


def group_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    accuracy: int = ACCURACY,
    approximate: bool = False,
    stats: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group: the keys, ``stats``, and an interpolated percentile per name.

    One aggregate gives each group's size, a quantile sketch that brackets each wanted rank,
    and the plain ``stats``. The brackets are joined onto the rows before anything is
    shuffled: in each task rows below a bracket become one count, rows above are dropped,
    and only those inside go on by value. So no task holds a large group, and the answer is
    exact: should a bracket miss its rank, which the counts show, it is opened on that side
    and the rows of that group are placed again. Groups without values are left out unless
    ``stats`` asks for all groups.
    """
    half = 4.0 / accuracy
    edges = [min(max(p + side * half, 0.0), 1.0) for p in probs.values() for side in (-1, 1)]
    sketch = df.groupBy(*keys).agg(
        F.count(value).alias("_n"),
        F.percentile_approx(value, edges, accuracy).cast("array<double>").alias("_edges"),
        *[F.percentile_approx(value, p, accuracy).alias(f"_a_{n}") for n, p in probs.items() if approximate],
        *[c.alias(n) for n, c in (stats or {}).items()],
    )
    if not stats:
        sketch = sketch.where("_n > 0")
    if approximate:
        return sketch.select(*keys, *(stats or {}), *[F.col(f"_a_{n}").alias(n) for n in probs])
    return bracketed_percentiles(df, keys, value, probs, sketch, F.col("_n") <= accuracy, list(stats or {}))


def bracketed_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], sketch: DataFrame,
    whole: Column, kept: list[str] | None = None,
) -> DataFrame:
    """Exact percentiles of groups whose sizes ``_n`` and brackets ``_edges``, two for each
    percentile, are known from any sketch. ``whole`` says which groups are put in order whole;
    ``kept`` columns of the sketch are carried along."""
    sketch, fits = measured(sketch)
    targets = sketch.select(
        *keys,
        F.explode(F.array(*[
            F.struct(
                F.lit(i).alias("i"),
                (F.lit(p) * (F.col("_n") - 1)).alias("rank"),
                F.when(~whole, F.col("_edges")[2 * i]).alias("lo"),
                F.when(~whole, F.col("_edges")[2 * i + 1]).alias("hi"),
            )
            for i, p in enumerate(probs.values())
        ])).alias("_t"),
    )
    present = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    # A row for each group and rank: computed once, and looked at for misses, which are rare.
    placed, known = measured(_placed(present, targets, keys, fits))
    missed = F.col("_low").isNull() | F.col("_high").isNull()
    wider = placed.where(missed).select(
        *keys,
        F.struct(
            F.col("_i").alias("i"), F.col("_rank").alias("rank"),
            F.when(F.floor("_rank") >= F.col("_below"), F.col("_lo")).alias("lo"),
            F.when(F.ceil("_rank") < F.col("_reached"), F.col("_hi")).alias("hi"),
        ).alias("_t"),
    )
    found = placed.where(~missed)
    if not known or not placed.where(missed).isEmpty():
        found = found.unionByName(_placed(present, wider, keys, fits))
    exact = F.col("_low") + (F.col("_rank") - F.floor("_rank")) * (F.col("_high") - F.col("_low"))
    answers = found.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        *[F.max(F.when(F.col("_i") == i, exact)).alias(n) for i, n in enumerate(probs)]
    )
    return sketch.join(answers, _same(keys), "left").select(*keys, *(kept or []), *probs)


def _same(keys: list[str]) -> Column:
    """A null group meets its own row."""
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], F.lit(True)
    )


def _placed(present: DataFrame, targets: DataFrame, keys: list[str], fits: bool) -> DataFrame:
    """Per group and rank: the values at its floor and ceiling, null where the bracket
    misses them, and how many rows lie below the bracket and up to its end."""
    targets = targets.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_t")
    rows = present.join(F.broadcast(targets) if fits else targets, _same(keys))
    v, lo, hi = F.col("_v"), F.col("_t.lo"), F.col("_t.hi")
    inside = (lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi))
    rank = [F.col(f"_t.{c}").alias(f"_{c}") for c in ("i", "rank", "lo", "hi")]
    counts = (
        rows.where(hi.isNull() | (v <= hi))
        .groupBy(*keys, *rank, F.when(inside, v).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    of_rank = [*keys, "_i", "_rank", "_lo", "_hi"]
    running = F.sum("_c").over(
        Window.partitionBy(*of_rank)
        .orderBy(F.asc_nulls_first("_v"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = counts.withColumn("_end", running).withColumn("_start", F.col("_end") - F.col("_c"))

    def at(position: Column) -> Column:
        hit = (F.col("_start") <= position) & (position < F.col("_end"))
        return F.max(F.when(hit, F.col("_v")))

    return ordered.groupBy(*of_rank).agg(
        at(F.floor("_rank")).alias("_low"),
        at(F.ceil("_rank")).alias("_high"),
        F.coalesce(F.max(F.when(F.col("_v").isNull(), F.col("_end"))), F.lit(0)).alias("_below"),
        F.max("_end").alias("_reached"),
    )
