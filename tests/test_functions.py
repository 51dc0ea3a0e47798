from __future__ import annotations

from datetime import date, timedelta

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalstar.functions import calendar as C
from signalstar.functions import cleaning as K
from signalstar.functions import measures as M
from signalstar.functions.text import is_significant, letter_runs, names_entity


def days(spark, values):
    return spark.createDataFrame([(v,) for v in values], "d date")


def test_week_runs_sunday_to_saturday(spark):
    first = date(2023, 1, 1)  # a Sunday
    got = rows(days(spark, [first + timedelta(n) for n in range(8)]).select(C.week_start(F.col("d"))))
    assert [g[0] for g in got] == [first] * 7 + [date(2023, 1, 8)]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dates(date(1900, 1, 1), date(2100, 1, 1)), min_size=1, max_size=50))
def test_week_start_properties(spark, values):
    d = F.col("d")
    week = C.week_start(d)
    got = rows(days(spark, values).select("d", week, C.week_start(week), C.key_to_date(C.date_key(d)),
                                          C.date_key(d)))
    for day, sunday, again, back, key in got:
        assert sunday.weekday() == 6 and 0 <= (day - sunday).days <= 6
        assert again == sunday and back == day
        assert key == int(day.strftime("%Y%m%d"))


def test_calendar_has_209_weeks(spark):
    weeks = C.calendar(spark)
    got = rows(weeks.orderBy("date_id"))
    assert len(got) == 209
    assert got[0] == (20230101, date(2023, 1, 1), 1, 1, 2023)
    assert got[-1] == (20261227, date(2026, 12, 27), 12, 4, 2026)


def test_calendar_starts_with_the_week_of_a_midweek_start(spark):
    got = rows(C.calendar(spark, date(2023, 1, 4), date(2023, 1, 15)).select("date").orderBy("date"))
    assert got == [(date(2023, 1, 1),), (date(2023, 1, 8),), (date(2023, 1, 15),)]


def test_quarter_labels(spark):
    got = rows(days(spark, [date(2026, 8, 9), date(2023, 2, 1)]).select(
        C.quarter_label(F.col("d")), C.quarter_end(F.col("d"))))
    assert got == [("Q3 2026", date(2026, 9, 30)), ("Q1 2023", date(2023, 3, 31))]


def cells(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_national_score(spark):
    got = rows(cells(spark, ["7", " <1 ", "<10", "", None, "NaN", "x", "0"]).select(K.national_score(F.col("v"))))
    assert [g[0] for g in got] == [7.0, 0.5, None, None, None, None, None, 0.0]


def test_percent_score(spark):
    got = rows(cells(spark, ["4%", "<1%", "<10%", "", "  ", None, "nan", " 27% ", "5", "x%"]).select(
        K.percent_score(F.col("v"))))
    assert [g[0] for g in got] == [4.0, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0, 27.0, 5.0, None]


def test_snapshot_week_floors_to_sunday(spark):
    got = rows(cells(spark, ["baseline", "current", "other"]).select(K.snapshot_week(F.col("v"))))
    assert [g[0] for g in got] == [date(2023, 1, 1), date(2026, 5, 10), None]


def test_stamps(spark):
    one = cells(spark, ["x"])
    got = rows(one.select(
        K.stamp_week(F.lit("20260609T133000Z"), K.NEWS_STAMP),
        K.stamp_week(F.lit("2026/08/11 00:00"), K.PUBLICATION_STAMP),
        K.pageview_day(F.lit("2023010100")),
        K.stamp_week(F.lit("soon"), K.NEWS_STAMP),
    ))
    assert got == [(date(2026, 6, 7), date(2026, 8, 9), date(2023, 1, 1), None)]


def test_latest_year_compares_numbers(spark):
    df = spark.createDataFrame([({"999": 1, "2023": 5, "2024": 7},)], "m map<string,bigint>")
    assert rows(df.select(K.latest_year(F.col("m")))) == [("2024",)]


def test_sentence_case_keeps_the_rest(spark):
    assert rows(cells(spark, ["bPC-157 x", "", "a"]).select(K.sentence_case(F.col("v")))) == [
        ("BPC-157 x",), ("",), ("A",)]


def test_rounding_goes_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (1.005,), (2.5e-9,)], "x double")
    assert [r[0] for r in rows(df.select(M.rounded(F.col("x"))))] == [0.13, -0.13, 1.01, 0.0]


def test_growth_of_zero_baseline_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 4.0), (None, 4.0)], "c double, b double")
    assert [r[0] for r in rows(df.select(M.growth_pct(F.col("c"), F.col("b"))))] == [None, 25.0, None]


@settings(max_examples=15, deadline=None)
@given(st.floats(1, 1e6), st.floats(1, 1e6), st.floats(0.01, 100))
def test_growth_does_not_depend_on_scale(spark, current, baseline, scale):
    df = spark.createDataFrame(
        [(current, baseline), (current * scale, baseline * scale)], "c double, b double")
    plain, scaled = [r[0] for r in rows(df.select(M.growth_pct(F.col("c"), F.col("b"))))]
    assert abs(plain - scaled) <= 1e-6 * max(1.0, abs(plain))


def test_correlation_of_constant_or_single_pair_is_null(spark):
    data = [("const", 1.0, 2.0), ("const", 1.0, 3.0), ("one", 1.0, 2.0), ("one", 4.0, None),
            ("up", 1.0, 10.0), ("up", 2.0, 20.0), ("up", 3.0, None), ("up", None, 5.0)]
    df = spark.createDataFrame(data, "k string, x double, y double")
    got = dict(rows(df.groupBy("k").agg(M.pair_correlation(F.col("x"), F.col("y")))))
    assert got["const"] is None and got["one"] is None
    assert abs(got["up"] - 1.0) < 1e-12


def test_tokens(spark):
    got = rows(cells(spark, ["(GHK-Cu) Copper 12 repair"]).select(letter_runs(F.col("v"))))
    assert got == [(["", "ghk", "cu", "copper", "repair"],)]
    words = cells(spark, ["cu", "copper", "clinical", "epitalon", ""])
    kept = words.where(is_significant(F.col("v"))).where(~names_entity(F.col("v"), F.lit("Epitalon")))
    assert rows(kept) == [("copper",)]
