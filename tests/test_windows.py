"""Stored sketches over any weeks, and lift around any date."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalstar.operators import lift, score_sketches
from signalstar.operators.distribution import QUARTILES


def scores(spark, n=60_000):
    """A source with most of the rows, one with equal values, one with few."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 10 < 8 THEN 1 WHEN id % 10 = 8 THEN 2 ELSE 3 END AS source_id",
        "CAST(id DIV 1000 AS INT) AS week",
        "IF(id % 97 = 0, NULL, IF(id % 10 = 8, 7.0D, CAST(hash(id) % 100000 AS DOUBLE))) AS score")


def span_values(rows, first, last):
    found = {}
    for r in rows.where(F.col("week").between(first, last) & F.col("score").isNotNull()).collect():
        found.setdefault(r.source_id, []).append(r.score)
    return {k: np.sort(v) for k, v in found.items()}


@pytest.fixture(scope="module")
def cells(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "t")
    score_sketches.sketch_cells(scores(spark), ["source_id"], "week", "score").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("first,last", [(0, 59), (7, 7), (10, 41)])
def test_sketched_ranks_are_within_their_error(spark, cells, first, last):
    want = span_values(scores(spark), first, last)
    probs = {"p01": 0.01, "median": 0.5, "p99": 0.99}
    for r in score_sketches.span_quantiles(cells, ["source_id"], first, last, probs).collect():
        values = want[r.source_id]
        assert r.n == len(values)
        for name, p in probs.items():
            low, high = (np.searchsorted(values, r[name], side) / len(values) for side in ("left", "right"))
            error = score_sketches.RANK_ERROR + 1 / len(values)
            assert low - error <= p <= high + error


@pytest.mark.parametrize("first,last", [(0, 59), (7, 7), (10, 41), (70, 80)])
def test_exact_quantiles_of_a_span(spark, cells, first, last):
    want = span_values(scores(spark), first, last)
    got = score_sketches.exact_span_quantiles(
        cells, scores(spark), ["source_id"], "week", "score", first, last, QUARTILES).collect()
    assert {r.source_id for r in got} == set(want)
    for r in got:
        assert r.n == len(want[r.source_id])
        for name, p in QUARTILES.items():
            assert r[name] == pytest.approx(np.quantile(want[r.source_id], p), abs=1e-9)


def test_estimates_read_no_rows(spark, cells):
    plan = score_sketches.span_quantiles(cells, ["source_id"], 3, 9, QUARTILES)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("FileScan") == 1 and "PushedFilters: [IsNotNull(week)" in text


def lift_days(seed, entities=3, days=200):
    """One entity holds nine tenths of the days."""
    random_ = random.Random(seed)
    start = date(2023, 1, 1)
    rows, marks = [], []
    for day in range(days):
        for e in range(entities):
            if e == 0 or random_.random() < 0.05:
                rows += [(e, start + timedelta(day), random_.choice([None, 0.0, float(random_.randrange(50))]))
                         for _ in range(random_.randrange(3))]
            if random_.random() < 0.2:
                marks += [(e, start + timedelta(day))] * 2
    return rows, marks + [(9, start), (0, start - timedelta(400))]


@pytest.mark.parametrize("seed,days", [(1, 1), (2, 14), (3, 45)])
def test_lift_at_any_date_against_brute_force(spark, seed, days):
    rows, marks = lift_days(seed)
    interest = spark.createDataFrame(rows, "entity_id int, date date, score double")
    events = spark.createDataFrame(marks, "entity_id int, date date")
    got = {(r.entity_id, r.event_date): r for r in lift.lift_at(interest, events, days).collect()}
    assert set(got) == set(marks)
    for (entity, at), r in got.items():
        def mean(first, last, entity=entity, at=at):
            found = [s for e, d, s in rows if e == entity and s is not None and first <= (d - at).days < last]
            return sum(found) / len(found) if found else None

        pre, post = mean(-days, 0), mean(0, days)
        change = 100 * (post - pre) / pre if pre and post is not None else None
        for mine, theirs in ((r.pre, pre), (r.post, post), (r.search_lift_pct, change)):
            assert (mine is None) == (theirs is None)
            assert mine is None or abs(mine - theirs) <= 0.0051


def test_lift_at_joins_on_equal_keys(spark):
    rows, marks = lift_days(4)
    interest = spark.createDataFrame(rows, "entity_id int, date date, score double")
    found = lift.lift_at(interest, spark.createDataFrame(marks, "entity_id int, date date"), 14)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan
