"""Load a star: write, audit what was written, publish it as a whole or not at all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from signalstar.operators import quality
from signalstar.operators.quality import CountRule, RowRule
from signalstar.plans.star import Star
from signalstar.sources import snapshots
from signalstar.sources.schemas import DIMENSIONS, FACTS
from signalstar.sources.tables import write_observed

# Facts are read by date window, so their files are ordered by date.
SORT_FACTS = {"interest": ["date_id"], "events": ["event_date"]}


@dataclass(frozen=True)
class Audit:
    """What a table has to keep: rules on its rows, and columns that are unique together."""

    rules: list[RowRule | CountRule] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)


def load_star(
    spark: SparkSession, star: Star, folder: str,
    checks: dict[str, Callable[[Star], DataFrame]] | None = None,
    partition_facts: dict[str, list[str]] | None = None,
    audits: dict[str, Audit] | None = None,
) -> dict[str, int]:
    """Replace all tables of a star that are given, and return the row counts.

    Each table is computed once: it is written to a folder that nobody reads yet, and its row
    rules are counted on the way. Keys that must be unique, the keys of both facts and any
    checks of the caller are then put to what was written. If one fails, the load is refused
    and the stored star stays as it was; else all tables are published by one manifest. A
    caller's own checks add to the key check, they do not replace it. A table that is not
    given stays as stored, and a stored fact is checked against new dimensions as well, so
    reloading a dimension cannot leave orphans unseen. A job lost half way is simply run
    again.
    """
    checks, partitions, audits = checks or {}, partition_facts or {}, audits or {}
    base, load = snapshots.current(spark, folder), snapshots.new_load()
    reports, versions = [], []
    for name in star.names():
        audit = audits.get(name, Audit())
        path = snapshots.version_path(name, load)
        seen = write_observed(
            star.table(name), f"{folder}/{path}", partitions.get(name), SORT_FACTS.get(name),
            quality.rule_metrics(audit.rules),
        )
        versions.append(snapshots.Version(name, path, seen["rows"]))
        if audit.rules:
            reports.append(quality.observed_report(spark, name, audit.rules, seen))
    fresh = base.with_tables(versions)
    written = Star.of_snapshot(spark, folder, fresh)
    for name, audit in audits.items():
        if audit.unique:
            reports.append(quality.unique_report(written.table(name), name, audit.unique))
    if set(DIMENSIONS) <= set(fresh.tables):
        reports += [
            quality.key_report(written.table(f), f, written.foreign_keys(f))
            for f in FACTS if f in fresh.tables
        ]
    reports += [check(written) for check in checks.values()]
    if reports:
        quality.enforce(reduce(DataFrame.unionByName, reports))
    snapshots.publish(spark, folder, fresh, load)
    return {v.name: v.rows for v in versions}
