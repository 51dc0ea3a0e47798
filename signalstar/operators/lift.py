"""Does interest rise after an event by more than it does anyway?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstar.functions.measures import growth_pct, rounded, share_pct

WINDOW_DAYS = 28
SPIKE_DEVIATIONS = 2.0


def weekly_points(interest: DataFrame, events: DataFrame) -> DataFrame:
    """One row per entity and week that has interest, an event, or both.

    Wants ``entity_id, date, score`` and ``entity_id, date``. An entity has at most one
    row per week from here on, which bounds every window below.
    """
    scores = interest.groupBy("entity_id", "date").agg(F.avg("score").alias("score"))
    marks = events.select("entity_id", "date").distinct()
    both = scores.select("entity_id", "date", "score", F.lit(0).alias("is_event")).unionByName(
        marks.select("entity_id", "date", F.lit(None).cast("double").alias("score"),
                     F.lit(1).alias("is_event"))
    )
    return both.groupBy("entity_id", "date").agg(
        F.max("score").alias("score"), F.max("is_event").alias("is_event")
    )


def with_lift(points: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Lift around every point and around its control week.

    before = mean score of [d - days, d), after = mean of [d, d + days). The control is
    the latest scored week at least two windows earlier with no event within a window
    of it; without one, or with a zero mean before, the lift is NULL. All frames share
    one partitioning and order, so the points are shuffled and sorted once; no join.
    """
    line = Window.partitionBy("entity_id").orderBy("_day")

    def frame(first: int, last: int):
        return line.rangeBetween(first, last)

    score = F.col("score")
    pre = F.avg(score).over(frame(-days, -1))
    post = F.avg(score).over(frame(0, days - 1))
    events_near = F.max("is_event").over(frame(-days, days - 1))
    around = points.withColumn("_day", F.unix_date("date")).select(
        "*", pre.alias("pre"), post.alias("post"), events_near.alias("_near")
    ).withColumn("search_lift", growth_pct(F.col("post"), F.col("pre")))
    quiet = F.when(
        score.isNotNull() & (F.col("_near") == 0),
        F.struct(F.col("date").alias("week"), F.col("search_lift").alias("lift")),
    )
    control = F.last(quiet, ignorenulls=True).over(
        line.rangeBetween(Window.unboundedPreceding, -2 * days)
    )
    return around.withColumn("_control", control).select(
        "entity_id", "date", "_day", "score", "is_event", "pre", "post", "search_lift",
        F.col("_control.week").alias("control_week"),
        F.col("_control.lift").alias("baseline_lift"),
        (F.col("search_lift") - F.col("_control.lift")).alias("excess_lift"),
    )


def event_lift(interest: DataFrame, events: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """KPI 9.6: one row per entity and event week."""
    lifted = with_lift(weekly_points(interest, events), days).where(F.col("is_event") == 1)

    def shown(name: str) -> Column:
        return rounded(F.col(name)).alias(name)

    return lifted.select(
        "entity_id",
        F.col("date").alias("event_date"),
        "control_week",
        shown("pre"),
        shown("post"),
        rounded(F.col("search_lift")).alias("search_lift_pct"),
        rounded(F.col("baseline_lift")).alias("baseline_lift_pct"),
        rounded(F.col("excess_lift")).alias("excess_lift_pct"),
    )


def spikes_with_events(
    interest: DataFrame, events: DataFrame, days: int = WINDOW_DAYS,
    deviations: float = SPIKE_DEVIATIONS,
) -> DataFrame:
    """Major spikes, and whether an event with excess lift lies in the window up to
    and including the spike's week."""
    lifted = with_lift(weekly_points(interest, events), days)
    entity = Window.partitionBy("entity_id")
    recent = entity.orderBy("_day").rangeBetween(-days, 0)
    level = F.avg("score").over(entity) + deviations * F.stddev("score").over(entity)
    helped = F.when((F.col("is_event") == 1) & (F.col("excess_lift") > 0), 1).otherwise(0)
    return lifted.select(
        "entity_id",
        "date",
        "score",
        level.alias("level"),
        (F.max(helped).over(recent) == 1).alias("attributed"),
    ).where(F.col("score") >= F.col("level"))


def event_attribution(
    interest: DataFrame, events: DataFrame, days: int = WINDOW_DAYS,
    deviations: float = SPIKE_DEVIATIONS, by_entity: bool = False,
) -> DataFrame:
    """KPI 9.7: the share of major spikes that an event explains."""
    spikes = spikes_with_events(interest, events, days, deviations)
    grouped = spikes.groupBy("entity_id") if by_entity else spikes.groupBy()
    counts = grouped.agg(
        F.count(F.lit(1)).alias("total_spikes"), F.count_if("attributed").alias("attributed_spikes")
    )
    return counts.withColumn(
        "attribution_rate_pct",
        rounded(share_pct(F.col("attributed_spikes"), F.col("total_spikes"))),
    )


def lift_at(interest: DataFrame, events: DataFrame, days: int) -> DataFrame:
    """The lift of any event date, on daily interest: one row per entity and event date.

    Wants ``entity_id, date, score`` and ``entity_id, date``. before is the mean of the rows in
    [d - days, d), after that of [d, d + days); where one is missing or before is zero, the
    lift is NULL. Days are dealt into buckets as wide as the window and every event is sent to
    its own bucket and both next to it, so the join is one of equal keys whose groups hold
    three windows at most, however many days or events an entity has.
    """
    day = F.unix_date("date")
    bucket = F.floor(day / days)
    daily = interest.groupBy("entity_id", "date").agg(
        F.sum("score").alias("total"), F.count("score").alias("n")
    ).select("entity_id", bucket.alias("_bucket"), day.alias("_day"), "total", "n")
    marks = events.select("entity_id", "date").distinct().select(
        "entity_id", F.col("date").alias("event_date"), day.alias("_at"),
        F.explode(F.sequence(bucket - 1, bucket + 1)).alias("_bucket"),
    )
    near = F.col("_day").between(F.col("_at") - days, F.col("_at") + days - 1)
    same = [marks.entity_id == daily.entity_id, marks["_bucket"] == daily["_bucket"]]
    joined = marks.join(daily, [*same, near], "left").select(
        marks.entity_id, "event_date", (F.col("_day") < F.col("_at")).alias("_early"), "total", "n")

    def mean(early: bool) -> Column:
        side = F.col("_early") == early
        return F.sum(F.when(side, F.col("total"))) / F.nullif(F.sum(F.when(side, F.col("n"))), F.lit(0))

    found = joined.groupBy("entity_id", "event_date").agg(
        mean(True).alias("pre"), mean(False).alias("post"))
    return found.select(
        "entity_id", "event_date", rounded(F.col("pre")).alias("pre"), rounded(F.col("post")).alias("post"),
        rounded(growth_pct(F.col("post"), F.col("pre"))).alias("search_lift_pct"),
    )
