"""Versions of a star: published whole or not at all, audited on what was written."""

from __future__ import annotations

import os

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from signalstar.operators import quality as Q
from signalstar.plans import warehouse
from signalstar.plans.order_star import order_star
from signalstar.plans.star import Star
from signalstar.plans.warehouse import Audit, load_star
from signalstar.sources import snapshots
from signalstar.sources.schemas import DIMENSIONS, FACTS, TABLES


@pytest.fixture(scope="module")
def star(spark):
    return order_star(spark, SMALL)


def counts(spark, folder):
    return {name: t.count() for name, t in Star.read(spark, folder).tables().items()}


def without_one_entity(star):
    first = star.entities.agg(F.min("entity_id")).scalar()
    return star.but(entities=star.entities.where(F.col("entity_id") != first))


def test_a_refused_load_leaves_every_table(spark, star, tmp_path):
    folder = str(tmp_path)
    loaded = load_star(spark, star, folder)
    with pytest.raises(Q.QualityError, match="interest.entity_id: foreign_key"):
        load_star(spark, without_one_entity(star), folder)
    assert counts(spark, folder) == loaded
    assert len(snapshots.snapshots(spark, folder)) == 1


def test_own_checks_add_to_the_key_check(spark, star, tmp_path):
    clean = lambda s: Q.row_report(s.interest, "interest", Q.no_nulls("date_id"))
    with pytest.raises(Q.QualityError, match="entity_id: foreign_key"):
        load_star(spark, without_one_entity(star), str(tmp_path), {"interest": clean})
    assert Star.read(spark, str(tmp_path / "none")).names() == list(TABLES)


@pytest.mark.parametrize("lost", ["dates", "interest", "events", "manifest"])
def test_a_killed_load_leaves_every_table(spark, star, tmp_path, monkeypatch, lost):
    """Stopped after some of its tables, or with all written and nothing published."""
    folder = str(tmp_path)
    loaded = load_star(spark, star, folder)

    def write(df, path, *rest):
        if f"/{lost}/" in path:
            raise KeyboardInterrupt
        return real(df, path, *rest)

    def publish(*_):
        raise KeyboardInterrupt

    real = warehouse.write_observed
    monkeypatch.setattr(warehouse, "write_observed", write)
    if lost == "manifest":
        monkeypatch.setattr(warehouse.snapshots, "publish", publish)
    half = star.but(interest=star.interest.limit(10), entities=star.entities)
    with pytest.raises(KeyboardInterrupt):
        load_star(spark, half, folder)
    monkeypatch.undo()
    assert counts(spark, folder) == loaded
    left = {r.path.split("/")[1] for r in snapshots.orphaned_loads(spark, folder).collect()}
    assert left == set(list(TABLES)[: list(TABLES).index(lost)] if lost in TABLES else TABLES)
    assert load_star(spark, half, folder)["interest"] == 10
    assert counts(spark, folder)["interest"] == 10


def test_a_manifest_begun_but_not_finished_is_passed_over(spark, star, tmp_path):
    folder = str(tmp_path)
    load_star(spark, star, folder)
    os.makedirs(tmp_path / "manifests" / "version=2" / "_temporary" / "0")
    load_star(spark, star.but(interest=star.interest.limit(7)), folder)
    assert [s.number for s in snapshots.snapshots(spark, folder)] == [1, 3]
    assert counts(spark, folder)["interest"] == 7


def test_of_two_loads_at_once_the_later_is_refused(spark, tmp_path):
    folder = str(tmp_path)
    base = snapshots.current(spark, folder)
    one = base.with_tables([snapshots.Version("t", "tables/t/a", 1)])
    other = base.with_tables([snapshots.Version("t", "tables/t/b", 2)])
    assert snapshots.publish(spark, folder, one, "a").number == 1
    with pytest.raises(snapshots.StaleSnapshot):
        snapshots.publish(spark, folder, other, "b")
    assert snapshots.current(spark, folder).tables["t"].path == "tables/t/a"


def test_a_reader_keeps_its_version(spark, star, tmp_path):
    folder = str(tmp_path)
    load_star(spark, star, folder)
    reader = Star.read(spark, folder)
    whole = reader.interest.count()
    load_star(spark, star.but(interest=star.interest.limit(3)), folder)
    assert reader.events.count() > 0 and reader.interest.count() == whole
    assert Star.read(spark, folder).interest.count() == 3


def test_only_some_tables(spark, star, tmp_path):
    """What is not given stays, and a new dimension is held against the stored facts."""
    folder = str(tmp_path)
    loaded = load_star(spark, star, folder)
    assert load_star(spark, Star(interest=star.interest.limit(5)), folder) == {"interest": 5}
    assert counts(spark, folder) == {**loaded, "interest": 5}
    used = star.events.agg(F.min("entity_id")).scalar()
    short = star.entities.where(F.col("entity_id") != used)
    with pytest.raises(Q.QualityError, match="events.entity_id: foreign_key"):
        load_star(spark, Star(entities=short), folder)


def test_old_versions_are_retired(spark, star, tmp_path):
    folder = str(tmp_path)
    load_star(spark, star, folder)
    for n in (3, 4):
        load_star(spark, Star(interest=star.interest.limit(n)), folder)
    gone = snapshots.retire(spark, folder, keep=1)
    assert len(gone) == 2 and all(p.startswith("tables/interest/") for p in gone)
    assert counts(spark, folder)["interest"] == 4
    assert spark.read.parquet(f"{folder}/{gone[0]}").count() == 0


def rules():
    return {
        "interest": Audit(Q.no_nulls("date_id", "interest_score") + [
            Q.within("interest_score", 0, 1e12), Q.row_count(10)]),
        "entities": Audit(Q.no_nulls("entity_name"), ["entity_id"]),
    }


def test_observed_rules_match_the_report(spark, star, tmp_path):
    """What is counted while rows are written is what a second pass would count."""
    own = [Q.within("interest_score", 0, 1000), *Q.no_nulls("region_id", "date_id"),
           Q.row_count(3), Q.regional_row_count(0)]
    path = f"{tmp_path}/t"
    seen = warehouse.write_observed(star.interest, path, None, None, Q.rule_metrics(own))
    want = rows(Q.row_report(star.interest, "interest", own))
    assert rows(Q.observed_report(spark, "interest", own, seen)) == want
    assert sum(r[3] > 0 for r in want) >= 3
    none = warehouse.write_observed(star.interest.limit(0), f"{tmp_path}/none", None, None, Q.rule_metrics(own))
    assert none["rows"] == 0
    assert rows(Q.observed_report(spark, "interest", own, none)) == rows(
        Q.row_report(star.interest.limit(0), "interest", own))


def test_every_table_is_computed_once(spark, star, tmp_path):
    """Rules, keys and uniqueness do not compute the rows of a fact again."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    facts = {name: star.table(name).mapInPandas(count, star.table(name).schema) for name in FACTS}
    audits = {**rules(), "interest": Audit(rules()["interest"].rules[:-1]),
              "events": Audit(Q.no_nulls("event_date"))}
    check = {"events": lambda s: Q.row_report(s.events, "events", Q.no_nulls("entity_id"))}
    loaded = load_star(spark, star.but(**facts), str(tmp_path), check, audits=audits)
    assert seen.value == sum(loaded[name] for name in FACTS)


def test_audits_are_enforced(spark, star, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(Q.QualityError, match="interest.*row_count"):
        load_star(spark, star, folder, audits=rules())
    twice = star.entities.unionByName(star.entities)
    with pytest.raises(Q.QualityError, match="entities.entity_id: unique"):
        load_star(spark, star.but(entities=twice), folder, audits={"entities": rules()["entities"]})
    assert snapshots.current(spark, folder) == snapshots.NOTHING
    assert set(DIMENSIONS) < set(star.names())
