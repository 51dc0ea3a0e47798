from __future__ import annotations

import math
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import as_set, rows
from pyspark.sql import functions as F

from signalstar.functions.calendar import calendar
from signalstar.operators import (
    coverage, cross_source, distribution, events, facts, growth, lift, quality, ranking, resolve,
    spikes, titles,
)
from signalstar.operators.percentiles import group_percentiles
from signalstar.operators.sizing import join_measured, measured
from signalstar.plans.star import Star
from signalstar.sources.schemas import ENTITIES, EVENTS, INTEREST, REGIONS, SOURCES
from signalstar.sources.tables import local_table

FIRST = date(2023, 1, 1)


def key(day):
    return int(day.strftime("%Y%m%d"))


def week(n):
    return FIRST + timedelta(days=7 * n)


def make_star(spark, interest, event_rows=(), weeks=None):
    return Star(
        entities=local_table(spark, [(1, "Ant", "a", None, True), (2, "Bee", "b", None, False),
                                     (3, "Cat", None, None, False)], ENTITIES),
        regions=local_table(spark, [(1, "North", 2_000_000), (2, "South", 500_000), (3, "Isle", 10)], REGIONS),
        sources=local_table(spark, [(1, "Trends", 7), (2, "Views", 6)], SOURCES),
        dates=calendar(spark, FIRST, weeks or date(2026, 12, 31)),
        interest=local_table(spark, list(interest), INTEREST),
        events=local_table(spark, list(event_rows), EVENTS),
    )


def series(entity, source, scores, region=None):
    return [(key(week(n)), entity, region, source, s) for n, s in enumerate(scores) if s is not None]


# --- growth ---------------------------------------------------------------------------


def test_windows_are_strict_and_baseline_wins(spark):
    """Week 13 starts on day 91 and is out; week 12 (day 84) is in."""
    scores = [1.0] * 13 + [50.0] * 4 + [3.0] * 13
    star = make_star(spark, series(1, 1, scores))
    assert rows(growth.overall_growth(star, "Trends")) == [(1.0, 3.0, 200.0)]
    # Overlapping windows: every row counts as baseline.
    short = make_star(spark, series(1, 1, [2.0, 4.0]))
    assert rows(growth.overall_growth(short, "Trends")) == [(3.0, None, None)]


def test_regional_rows_mix_in_unless_told_otherwise(spark):
    data = series(1, 1, [2.0] * 30) + [(key(FIRST), 1, 1, 1, 16.0)]
    star = make_star(spark, data)
    assert rows(growth.overall_growth(star, "Trends"))[0][0] == 3.0
    assert rows(growth.overall_growth(star, "Trends", national_only=True))[0][0] == 2.0


def test_entity_growth_puts_null_growth_last(spark):
    data = series(1, 1, [1.0] * 15 + [2.0] * 15) + series(2, 1, [0.0] * 15 + [2.0] * 15)
    data += series(3, 2, [1.0] * 30)
    star = make_star(spark, data)
    assert rows(growth.entity_growth(star, "Trends")) == [("Ant", 1.0, 2.0, 100.0), ("Bee", 0.0, 2.0, None)]


def test_calendar_bounds_leave_early_series_without_current(spark):
    star = make_star(spark, series(1, 1, [1.0] * 30))
    assert rows(growth.entity_source_growth(star)) == [("Ant", "Trends", 1.0, None, None)]


def test_region_growth_uses_regional_bounds(spark):
    data = series(1, 1, [5.0] * 60)
    data += [(key(week(0)), 1, 1, 1, 10.0), (key(week(30)), 1, 1, 1, 15.0),
             (key(week(0)), 1, 2, 1, 4.0), (key(week(30)), 1, 2, 1, 8.0)]
    star = make_star(spark, data)
    assert rows(growth.region_growth(star)) == [("South", 4.0, 8.0, 100.0), ("North", 10.0, 15.0, 50.0)]
    assert rows(growth.region_growth(star, with_population=True))[0][1] == 500_000
    assert rows(growth.region_per_million(star)) == [
        ("South", 500_000, 6.0, 12.0), ("North", 2_000_000, 12.5, 6.25)]
    assert rows(growth.total_per_million(star, "Trends")) == [(round(9.25 / 2.50001, 4),)]
    assert rows(growth.top_growing(star, "Trends"))[1] == ("region", "South", 100.0)
    assert rows(growth.reporting_bounds(star, "Trends")) == [
        ("all", week(0), week(59)), ("regional", week(0), week(30))]
    assert rows(growth.regional_detail(star))[0] == ("North", "Ant", week(0), 10.0)


def test_year_over_year_takes_a_partial_year(spark):
    data = [(20240107, 1, None, 1, 4.0), (20241229, 1, None, 1, 6.0), (20250105, 1, None, 1, 10.0)]
    star = make_star(spark, data)
    assert rows(growth.year_over_year(star, "Trends")) == [(2025, 2024, 10.0, 5.0, 100.0)]
    assert rows(growth.year_over_year(star, "Trends", complete_years_only=True)) == [
        (2024, 2023, 5.0, None, None)]


# --- spikes ---------------------------------------------------------------------------


def test_latest_of_equal_peaks(spark):
    star = make_star(spark, series(1, 1, [1.0, 3.0, 1.0, 3.0]) + series(2, 1, [0.0, 0.0]))
    got = rows(spikes.largest_spikes(star, "Trends"))
    assert got[0] == ("Ant", week(3), 3.0, 2.0, 50.0)
    assert got[1] == ("Bee", week(1), 0.0, 0.0, None)


def test_peak_ranks_keep_ties(spark):
    star = make_star(spark, series(1, 1, [1.0, 3.0, 1.0, 3.0]))
    assert [(r[1], r[5]) for r in rows(spikes.peak_ranks(star, "Trends"))] == [(week(1), 1), (week(3), 1)]
    ranks = {(r[1], r[5]) for r in rows(spikes.peak_ranks(star, "Trends", 3))}
    assert ranks == {(week(0), 3), (week(1), 1), (week(2), 3), (week(3), 1)}


# --- across sources -------------------------------------------------------------------


def test_correlation_counts_all_weeks_and_pairs(spark):
    data = series(1, 1, [1.0, 2.0, 3.0, 4.0]) + series(1, 2, [10.0, 20.0, 30.0, None])
    data += series(2, 1, [5.0, 5.0, 5.0]) + series(2, 2, [1.0, 2.0, 3.0])
    star = make_star(spark, data)
    assert rows(cross_source.correlations(star, "Trends", "Views")) == [
        ("Ant", 4, 3, 1.0), ("Bee", 3, 3, None)]
    side = rows(cross_source.side_by_side(star, "Trends", "Views"))
    assert side[3] == (week(3), "Ant", 4.0, None)
    assert as_set(cross_source.source_pivot(star, ["Trends", "Views"])) == set(side)


def test_source_agreement(spark):
    data = series(1, 1, [1.0] * 15 + [2.0] * 15) + series(1, 2, [1.0] * 15 + [2.0] * 15)
    data += series(2, 1, [2.0] * 15 + [1.0] * 15)
    marks = [(week(n), 1, 1, "News", "t", None, e) for n, e in ((0, 1), (0, 2), (28, 1), (29, 1))]
    star = make_star(spark, data, marks)
    assert rows(cross_source.source_agreement(star)) == [("Ant", 3, 3, True), ("Bee", 2, 0, False)]


# --- percentiles ----------------------------------------------------------------------


def test_percentiles_of_small_and_large_groups_are_exact(spark):
    rng = random.Random(5)
    data = [("hot", round(rng.gauss(50, 20), 3)) for _ in range(30_000)]
    data += [("steps", float(rng.choice([0, 1, 1, 1, 2, 9]))) for _ in range(5_000)]
    data += [("few", float(v)) for v in (4, 1, 3)] + [("one", 7.0)]
    data += [(None, float(v)) for v in range(2_001)] + [("few", None), ("empty", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    probs = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0, "p0": 0.0}
    frame = pd.DataFrame(data, columns=["k", "v"]).dropna(subset=["v"])
    for accuracy in (500, 100_000):
        got = {r[0]: r[1:] for r in rows(group_percentiles(df, ["k"], "v", probs, accuracy))}
        assert set(got) == {"hot", "steps", "few", "one", None}
        for k, values in got.items():
            mine = frame[frame.k.isna() if k is None else frame.k == k].v.to_numpy()
            want = [np.quantile(mine, p) for p in probs.values()]
            assert np.allclose(values, want, rtol=0, atol=1e-9), (k, accuracy)


def test_approximate_percentiles_are_an_option(spark):
    df = spark.range(1001).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    assert rows(group_percentiles(df, ["k"], "v", {"m": 0.5}, approximate=True)) == [("a", 500.0)]


def test_distribution_and_histogram(spark):
    star = make_star(spark, series(1, 1, [0.0, 50.0, 100.0, 25.0]) + series(1, 2, [5.0]))
    got = rows(distribution.score_distribution(star))
    assert got[0][:8] == ("Trends", 4, 0.0, 18.75, 37.5, 43.75, 62.5, 100.0)
    assert got[1] == ("Views", 1, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, None)
    bars = rows(distribution.score_histogram(star, buckets=4))
    assert bars == [("Trends", 1, 0.0, 1), ("Trends", 2, 25.0, 1), ("Trends", 3, 50.0, 1),
                    ("Trends", 4, 75.0, 1), ("Views", 1, 0.0, 1)]
    assert rows(distribution.weekly_trend(star, "Views")) == [(week(0), "Ant", "Views", 5.0)]
    assert distribution.weekly_trend(star).count() == 5


# --- coverage -------------------------------------------------------------------------


def test_coverage(spark):
    data = series(1, 1, [1.0, 2.0]) + [(key(FIRST), 1, 1, 1, 9.0)]
    marks = [(FIRST, 2, 1, "News", "t", 2, 2)]
    star = make_star(spark, data, marks)
    assert rows(coverage.entity_coverage(star)) == [(3, "Cat", 0, 0), (2, "Bee", 0, 1), (1, "Ant", 3, 0)]
    assert rows(coverage.region_coverage(star)) == [(3, "Isle", 0, 0), (2, "South", 0, 1), (1, "North", 1, 0)]
    assert dict(rows(coverage.row_counts(star.tables())))["interest"] == 3
    assert rows(coverage.null_regions(star)) == [("interest", 2, 3), ("events", 0, 1)]
    assert rows(coverage.null_region_rate(star)) == [("Trends", 3, 2, 66.67)]
    assert rows(coverage.date_range(star)) == [(FIRST, date(2026, 12, 27), 209)]
    nulls = {(t, c): n for t, c, n in rows(coverage.null_profile(star.tables()))}
    assert nulls["interest", "region_id"] == 2 and nulls["entities", "price_range"] == 3
    assert [r[0] for r in rows(coverage.regions_by_population(star))] == [1, 2, 3]
    assert [r[0] for r in rows(coverage.sources_by_reliability(star))] == [1, 2]
    assert [r[0] for r in rows(coverage.entity_list(star))] == [1, 2, 3]


def test_duplicates_treat_null_keys_as_equal(spark):
    star = make_star(spark, series(1, 1, [1.0]) * 2 + series(2, 1, [1.0]))
    got = rows(coverage.duplicates(star.interest, ["date_id", "entity_id", "region_id", "source_id"]))
    assert got == [(20230101, 1, None, 1, 2)]


def test_describe(spark):
    df = spark.createDataFrame([("a", True, None), ("b", True, None), ("a", False, None), ("b", None, None)],
                               "u string, ok boolean, p string")
    assert as_set(coverage.describe_columns(df)) == {
        ("u", 4, 2, "a", 2), ("ok", 3, 2, "true", 2), ("p", 0, 0, None, None)}
    nums = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    assert as_set(coverage.describe_numbers(nums, ["k"], "v")) == {
        ("a", 2, 2.0, round(math.sqrt(2), 4), 1.0, 3.0, 1.5, 2.0, 2.5),
        ("b", 0, *[None] * 7)}
    assert coverage.numeric_columns(nums) == ["v"]


# --- events ---------------------------------------------------------------------------


def event_rows():
    counts = [10, 9, 9, 8, 1, 1, 1, 1, 1, 1]
    return [(week(n), c, min(c, 5), "News" if n % 2 else "Study", f"t{n}", None, 1 + n % 2)
            for n, c in enumerate(counts)]


def test_event_counts(spark):
    star = make_star(spark, [], event_rows())
    assert as_set(events.by_category(star)) == {("News", 5), ("Study", 5)}
    assert rows(events.by_quarter(star)) == [(2023, 1, "News", 5), (2023, 1, "Study", 5)]
    assert as_set(events.by_quarter_label(star)) == {("Q1 2023", "News", 5), ("Q1 2023", "Study", 5)}
    assert rows(events.quarter_pivot(star, ["News", "Other"])) == [(date(2023, 3, 31), 5, None)]
    assert as_set(events.by_entity(star)) == {("Ant", 5), ("Bee", 5)}
    assert len(rows(events.on_calendar(star))) == 10


def test_high_attention_is_within_category(spark):
    star = make_star(spark, [], event_rows())
    # Study counts 10 9 1 1 1: p90 = 9.6; News 9 8 1 1 1: p90 = 8.6; publishers 5 5 1 1 1: 5.0.
    assert {r[3] for r in rows(events.high_attention(star))} == {"t0", "t1", "t2", "t3"}


def test_most_reported_keeps_ties_at_the_cut(spark):
    star = make_star(spark, [], event_rows())
    assert [(r[3], r[6]) for r in rows(events.most_reported(star, 2))] == [("t0", 1), ("t1", 2), ("t2", 2)]
    assert len(rows(events.most_reported(star, 5))) == 10
    assert len(rows(events.most_reported(star, 4))) == 4


def test_category_share(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)] * 2 + [("d",), (None,)], "k string")
    assert rows(ranking.category_share(df, "k")) == [
        ("a", 3, 37.5, 1), ("b", 2, 25.0, 2), ("c", 2, 25.0, 2), ("d", 1, 12.5, 4)]


# --- facts ----------------------------------------------------------------------------


def test_rollup_takes_the_first_title_that_exists(spark):
    data = [(1, FIRST, None, "News", "a.com", None, 0), (1, FIRST, None, "News", "b.com", "second", 1),
            (1, FIRST, None, "News", "b.com", "third", 2), (1, FIRST, None, "News", None, "fourth", 3),
            (2, FIRST, None, "News", "a.com", None, 0)]
    df = spark.createDataFrame(data, "entity_id int, week date, region_id int, category string,"
                                     " publisher string, title string, pos int").repartition(3)
    assert as_set(facts.event_rollup(df)) == {
        (FIRST, 4, 2, "News", "second", None, 1), (FIRST, 1, 1, "News", None, None, 2)}


def test_weekly_totals_and_own_peak_index(spark):
    days = [(1, FIRST + timedelta(days=n), n) for n in range(15)] + [(2, FIRST, 0), (2, week(1), 0)]
    daily = spark.createDataFrame(days, "entity_id int, day date, views bigint")
    weekly = facts.weekly_totals(daily, "day", "views")
    assert sum(r[2] for r in rows(weekly)) == sum(d[2] for d in days)
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows(facts.own_peak_index(weekly))}
    assert got[1, week(0)] == (21, 21 / 70 * 100) and got[1, week(1)] == (70, 100.0)
    assert got[1, week(2)] == (14, 20.0) and got[2, week(0)] == (0, 0.0)


def test_publications_floor_to_week_before_the_window(spark):
    df = spark.createDataFrame([(date(2026, 12, 27),), (date(2022, 12, 25),)], "week date")
    assert rows(facts.in_window(df, "week", date(2023, 1, 1), date(2026, 12, 31))) == [(date(2026, 12, 27),)]


def test_resolve(spark):
    dim = spark.createDataFrame([(1, "GHK-Cu"), (2, "Epitalon")], "entity_id int, entity_name string")
    df = spark.createDataFrame([(" ghk-cu",), ("EPITALON ",), ("other",), (None,)], "n string")
    got = as_set(resolve.resolve_ids(df, "n", dim, "entity_name", "entity_id"))
    assert got == {(" ghk-cu", 1), ("EPITALON ", 2), ("other", None), (None, None)}
    assert rows(resolve.unresolved(df, "n", dim, "entity_name")) == [("other",)]


# --- quality --------------------------------------------------------------------------


def bad_star(spark):
    data = [(20230101, 1, None, 1, None), (20230101, 1, 9, 1, 5.0), (20230108, 7, None, 1, 5.0),
            (20230108, 1, None, 1, 101.0), (20221225, 1, None, 1, 5.0), (20230108, 1, None, 1, 101.0),
            (20230108, 1, None, 3, 5.0)]
    marks = [(date(2027, 1, 3), 1, 2, "News", None, None, 1), (FIRST, 0, 0, "News", "t", None, 8)]
    return make_star(spark, data, marks)


def test_every_rule_finds_its_rows(spark):
    star = bad_star(spark)
    report = quality.report(
        star.interest, "interest",
        [*quality.no_nulls("interest_score"), quality.within("interest_score", 0, 100),
         quality.date_bounds("date_id", F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")),
         quality.valid_ids("entity_id", [1, 2, 3]), quality.regional_row_count(4), quality.row_count(7)],
        [quality.ForeignKey("region_id", star.regions, "region_id"),
         quality.ForeignKey("source_id", star.sources, "source_id")],
        ["date_id", "entity_id", "region_id", "source_id"])
    got = {(c, col): (n, s) for _, c, col, n, s in rows(report)}
    assert got == {
        ("no_nulls", "interest_score"): (1, None), ("within", "interest_score"): (2, "101.0"),
        ("date_bounds", "date_id"): (1, "20221225"), ("valid_ids", "entity_id"): (1, "7"),
        ("regional_row_count", "region_id"): (3, "1"), ("row_count", "*"): (0, None),
        ("foreign_key", "region_id"): (1, "9"), ("foreign_key", "source_id"): (1, "3"),
        ("unique", "date_id, entity_id, region_id, source_id"): (1, "20230108, 1, 1")}
    with pytest.raises(quality.QualityError, match="interest.entity_id: valid_ids fails 1 time"):
        quality.enforce(report)


def test_event_rules(spark):
    star = bad_star(spark)
    report = quality.report(
        star.events, "events",
        [*quality.no_nulls("title"), quality.date_bounds("event_date"),
         quality.at_least("related_article_count", 1), quality.not_above("source_count", "related_article_count")])
    assert [r[3] for r in rows(report)] == [1, 1, 1, 1]
    quality.enforce(quality.report(star.regions, "regions", quality.no_nulls("population")))


def test_first_ten_offenders_in_order(spark):
    df = spark.range(100).select(F.col("id").alias("fk"))
    parent = spark.range(50).select("id")
    found = quality.orphans(df, quality.ForeignKey("fk", parent, "id"))
    assert [r[0] for r in rows(quality.first_offenders(found))] == list(range(50, 60))


def test_missing_authored_and_cap(spark):
    star = make_star(spark, [])
    assert rows(quality.missing_authored(star.entities, "primary_usage", "entity_name")) == [("Cat",)]
    counts = spark.createDataFrame([("a", 250), ("b", 3)], "k string, n int")
    assert rows(quality.at_cap(counts, "n", 250)) == [("a", 250)]


# --- titles ---------------------------------------------------------------------------


def test_top_words_break_ties_by_first_appearance(spark):
    data = [("Zeta-One", "Zebra apple zebra of the clinical mango", 2),
            ("Zeta-One", "mango kiwis zeta ZEBRA", 1), ("b", "apple", 3)]
    df = spark.createDataFrame(data, "name string, title string, pos int")
    got = as_set(titles.top_words(df, "name", "title", "pos", top=3))
    assert got == {("Zeta-One", "zebra", 3, 1), ("Zeta-One", "mango", 2, 2), ("Zeta-One", "kiwis", 1, 3),
                   ("b", "apple", 1, 1)}


def test_top_words_take_any_order(spark):
    """Hashed ids: the order may be any 64-bit number."""
    data = [("a", "lemon grape", 2**62), ("a", "peach lemon grape", -(2**62)), ("a", "peach", 2**62 + 1)]
    df = spark.createDataFrame(data, "name string, title string, pos long")
    got = rows(titles.top_words(df, "name", "title", "pos", top=3).orderBy("rank"))
    assert [r[1] for r in got] == ["peach", "lemon", "grape"]


# --- lift -----------------------------------------------------------------------------


def brute_lift(scores, marks, days):
    """Lift of every mark by plain loops over (entity, week) dictionaries."""
    def change(e, d):
        pre = [s for (x, w), s in scores.items() if x == e and d - timedelta(days=days) <= w < d]
        post = [s for (x, w), s in scores.items() if x == e and d <= w < d + timedelta(days=days)]
        if not pre or not post or np.mean(pre) == 0:
            return None
        return 100 * (np.mean(post) - np.mean(pre)) / np.mean(pre)

    out = {}
    for e, d in marks:
        quiet = [w for (x, w) in scores if x == e and w <= d - timedelta(days=2 * days) and not any(
            y == e and w - timedelta(days=days) <= m < w + timedelta(days=days) for y, m in marks)]
        control = max(quiet) if quiet else None
        base = change(e, control) if control else None
        lifted = change(e, d)
        out[e, d] = (control, lifted, base, None if None in (lifted, base) else lifted - base)
    return out


def lift_case(spark, seed):
    rng = random.Random(seed)
    scores = {(e, week(n)): float(rng.randint(0, 9)) for e in ("a", "b") for n in range(60) if rng.random() < 0.8}
    marks = {(e, week(rng.randint(0, 65))) for e in ("a", "b", "c") for _ in range(5)}
    interest = spark.createDataFrame([(e, w, s) for (e, w), s in scores.items()],
                                     "entity_id string, date date, score double")
    events_df = spark.createDataFrame(sorted(marks) * 2, "entity_id string, date date")
    return scores, marks, interest, events_df


@pytest.mark.parametrize("seed", [1, 2])
def test_event_lift_against_brute_force(spark, seed):
    scores, marks, interest, events_df = lift_case(spark, seed)
    want = brute_lift(scores, marks, 28)
    got = {(r.entity_id, r.event_date): r for r in lift.event_lift(interest, events_df).collect()}
    assert set(got) == set(want)
    for k, (control, lifted, base, excess) in want.items():
        r = got[k]
        assert r.control_week == control
        for mine, theirs in ((r.search_lift_pct, lifted), (r.baseline_lift_pct, base), (r.excess_lift_pct, excess)):
            assert (mine is None) == (theirs is None)
            assert mine is None or abs(mine - theirs) <= 0.0051


def test_attribution_against_brute_force(spark):
    scores, marks, interest, events_df = lift_case(spark, 3)
    lifted = brute_lift(scores, marks, 28)
    total = hit = 0
    for e in ("a", "b"):
        mine = {w: s for (x, w), s in scores.items() if x == e}
        limit = np.mean(list(mine.values())) + 1.0 * np.std(list(mine.values()), ddof=1)
        for w, s in mine.items():
            if s >= limit:
                total += 1
                hit += any(x == e and w - timedelta(days=28) <= d <= w and v[3] is not None and v[3] > 0
                           for (x, d), v in lifted.items())
    got = rows(lift.event_attribution(interest, events_df, deviations=1.0))[0]
    assert got[:2] == (total, hit) and total > 0 and abs(got[2] - 100 * hit / total) <= 0.0051


def test_no_spikes_have_no_rate(spark):
    _, _, interest, events_df = lift_case(spark, 4)
    assert rows(lift.event_attribution(interest, events_df, deviations=99.0)) == [(0, 0, None)]


# --- sizing ---------------------------------------------------------------------------


def test_measured_side_falls_back_beyond_its_limit(spark):
    side = spark.range(100).groupBy((F.col("id") % 50).alias("k")).count()
    local, fits = measured(side, 50)
    assert fits and local.count() == 50
    same, fits = measured(side, 49)
    assert not fits and same is side
    big = spark.range(500).select((F.col("id") % 50).alias("k"))
    assert join_measured(big, side, "k", max_rows=49).count() == join_measured(big, side, "k").count() == 500


def test_star_of_renames_and_refuses_unknown_tables(spark):
    given = spark.createDataFrame([(1, "x")], "peptide_id int, peptide_name string")
    star = Star.of({"peptide_id": "entity_id", "peptide_name": "entity_name"}, entities=given)
    assert star.entities.columns == ["entity_id", "entity_name"]
    with pytest.raises(ValueError):
        Star(dim=given)
