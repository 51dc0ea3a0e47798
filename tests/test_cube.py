"""The cube against the facts it was made from."""

from __future__ import annotations

import pytest
from conftest import SMALL, as_set
from pyspark.sql import functions as F

from signalstar.operators import cube, growth, spikes
from signalstar.operators.cube import GROUPING_SETS, InterestCube
from signalstar.plans.order_star import FIRST_SOURCE, SECOND_SOURCE, order_star


@pytest.fixture(scope="module")
def star(spark):
    rows = order_star(spark, SMALL)
    return rows.but(interest=rows.interest.withColumn(
        "interest_score", F.when(F.col("interest_score") % 7 >= 1, F.col("interest_score"))))


@pytest.fixture(scope="module")
def made(star):
    return InterestCube.build(star.interest)


def test_every_grouping_adds_up(star, made):
    for grouping in made.groupings:
        keys = [F.col(k) for k in sorted(grouping.slicers)]
        want = star.interest.groupBy(*keys, F.col("region_id").isNotNull().alias("regional")).agg(
            F.count(F.lit(1)), F.count("interest_score"), F.round(F.sum("interest_score"), 4),
            F.min("interest_score"), F.max("interest_score"))
        got = grouping.cells.select(*keys, "regional", "rows", "n", F.round("total", 4), "low", "high")
        assert as_set(got) == as_set(want) and grouping.rows == want.count()


def test_the_smallest_table_answers(made):
    assert {g.slicers for g in made.groupings} == set(GROUPING_SETS)
    for asked, wanted in (({"source_id"}, {"source_id"}), ({"region_id"}, {"region_id", "source_id"}),
                          ({"entity_id", "date_id"}, {"date_id", "entity_id", "source_id"}),
                          ({"entity_id", "region_id"}, cube.SLICERS)):
        assert made.smallest(asked).slicers == wanted
    with pytest.raises(ValueError, match="no table"):
        InterestCube([]).smallest({"date_id"})


@pytest.mark.parametrize("source", [FIRST_SOURCE, SECOND_SOURCE])
def test_measures_equal_those_of_the_facts(star, made, source):
    assert as_set(cube.entity_growth(made, star, source)) == as_set(growth.entity_growth(star, source))
    assert as_set(cube.largest_spikes(made, star, source)) == as_set(spikes.largest_spikes(star, source))
    assert as_set(cube.region_per_million(made, star)) == as_set(growth.region_per_million(star))


def test_facts_are_not_scanned(star, made):
    for df in (cube.entity_growth(made, star, FIRST_SOURCE), cube.largest_spikes(made, star, FIRST_SOURCE),
               cube.region_per_million(made, star)):
        assert "orders.parquet" not in df._jdf.queryExecution().executedPlan().toString()
