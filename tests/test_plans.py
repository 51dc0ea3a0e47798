"""Plan shapes that decide whether a query survives large data."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL

from signalstar.operators import events, growth, percentiles, spikes, titles
from signalstar.operators.percentiles import group_percentiles
from signalstar.plans.catalog import QUERIES
from signalstar.plans.order_star import FIRST_SOURCE, order_star, table
from signalstar.plans.star import Star
from signalstar.plans.warehouse import load_star


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    load_star(spark, order_star(spark, SMALL), folder, partition_facts={"interest": ["source_id"]})
    return Star.read(spark, folder)


def test_windows_reach_the_scan_of_a_stored_fact(stored):
    df = growth.entity_growth(stored, FIRST_SOURCE)
    df.collect()
    text = plan(df)
    scan = re.search(r"FileScan parquet \[[^\n]*interest_score[^\n]*", text).group(0)
    assert re.search(r"DataFilters: \[[^\]]*subquery", scan), scan
    assert "source_id" in re.search(r"PartitionFilters: \[([^\]]*)", scan).group(1)
    assert "title" not in scan and "region_id" not in scan


def test_dimension_joins_of_a_stored_star_are_broadcast(stored):
    for df in (growth.regional_detail(stored), spikes.largest_spikes(stored, FIRST_SOURCE),
               events.most_reported(stored)):
        assert "SortMergeJoin" not in plan(df)


def test_facts_are_counted_before_the_shuffle(stored):
    text = plan(spikes.largest_spikes(stored, FIRST_SOURCE))
    assert "partial_max(interest_score" in text and "SortAggregate" not in text.split("partial_max(interest")[1]


def test_top_words_limit_each_task_before_the_sort(spark):
    text = plan(titles.top_words(table(spark, SMALL, "documents"), "source", "text", "doc_id"))
    partial = text.index("row_number(), 15, Partial")
    assert partial > text.index("row_number(), 15, Final")
    assert "partial_min" in text and "SortAggregate" not in text


def test_large_groups_are_never_held_by_one_percentile_buffer(spark, monkeypatch):
    df = table(spark, SMALL, "orders")
    real = percentiles.measured
    for accuracy in (50, 100_000):
        plans = []
        monkeypatch.setattr(percentiles, "measured", lambda side: plans.append(plan(side)) or real(side))
        found = group_percentiles(df, ["o_orderstatus"], "o_totalprice", {"m": 0.5}, accuracy)
        sketch, text = plans
        # The rows are counted by bracket in their own task before the only exchange of them.
        assert "percentile(" not in text and "raise_error" not in text
        below = text[text.index("partial_count"):]
        assert "Exchange hashpartitioning" not in below[: below.index("BroadcastHashJoin")]
        # What is left is a few rows on the driver: no bracket was missed, nothing is read again.
        assert "FileScan" not in plan(found)


def test_a_missed_bracket_is_opened(spark, monkeypatch):
    """A sketch that points far from the wanted ranks still gives the exact answer."""
    df = spark.range(5000).selectExpr("CAST(id * id AS DOUBLE) AS v", "id % 2 AS k")
    real = percentiles.F.percentile_approx
    for shift in (-0.3, 0.3):
        monkeypatch.setattr(
            percentiles.F, "percentile_approx",
            lambda c, p, a: real(c, [min(max(x + shift, 0.0), 1.0) for x in p], a),
        )
        got = {r.k: r.m for r in group_percentiles(df, ["k"], "v", {"m": 0.5}, accuracy=100).collect()}
        assert got == {0: (2498**2 + 2500**2) / 2, 1: (2499**2 + 2501**2) / 2}


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["kpi_overall_growth"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("c_name" not in s and "c_acctbal" not in s and "o_orderkey" not in s for s in schemas)


def test_facts_are_not_read_again_for_limits_and_bounds(spark):
    """What sizes, limits and bounds need comes from rows written once."""
    for name in ("events_high_attention", "source_agreement"):
        text = plan(QUERIES[name](spark, SMALL))
        assert not re.search(r"/(orders|events)\.parquet", text), name
