"""Profiles of wide tables against plain counts."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from conftest import SMALL

from signalstar.operators import coverage, profile
from signalstar.plans import derived_sources as derived
from signalstar.plans.order_star import table
from signalstar.sources import documents as docs


def shuffled_texts(df) -> list[str]:
    """The exchanges of a plan, each with what it moves."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def wide_rows(seed: int, n: int):
    rng = random.Random(seed)
    return [
        (rng.choice(["a", "b", None]), rng.randrange(4), f"only {i}", None,
         f"pair {i // 2 * 7919 % n:06d}", rng.choice(["", " ", "x" * 5000, "é"]))
        for i in range(n)
    ]


COLUMNS = ["few", "number", "alone", "none", "pairs", "texts"]
SCHEMA = "few string, number int, alone string, none string, pairs string, texts string"


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_wide_profile_equals_the_plain_one(spark, n):
    rows = wide_rows(n, n)
    got = {tuple(r) for r in profile.describe_wide(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = set()
    for c, cells in zip(COLUMNS, zip(*rows) if rows else [()] * len(COLUMNS)):
        counts = Counter(str(v) for v in cells if v is not None)
        top = min(counts, key=lambda v: (-counts[v], v.encode())) if counts else None
        want.add((c, sum(counts.values()), len(counts), top, counts[top] if counts else None))
    assert got == want


def test_more_winners_than_are_broadcast(spark, monkeypatch):
    """Every value of ``pairs`` is a winner; the smallest one is found beyond the drawn ones."""
    monkeypatch.setattr(profile, "WINNERS", 3)
    df = spark.createDataFrame(wide_rows(5, 3000), SCHEMA)
    assert set(profile.describe_wide(df).collect()) == set(coverage.describe_columns(df).collect())


@pytest.mark.parametrize("share", [0.5, 0.1, 0.004])
def test_frequent_values(spark, share):
    rng = random.Random(8)
    weights = [1 / k**1.3 for k in range(1, 3000)]
    values = rng.choices([f"v{k}" for k in range(1, 3000)], weights, k=20_000)
    rows = [(v if i % 5 else None, i) for i, v in enumerate(values)]
    counts = Counter(v for v, _ in rows if v is not None)
    total = sum(counts.values())
    df = spark.createDataFrame(rows, "word string, id long").repartition(7)
    got = {(r.column_name, r.value, r.n, r.n_values) for r in profile.frequent_values(df, share).collect()}
    assert got == {("word", v, n, total) for v, n in counts.items() if n >= share * total}
    assert profile.frequent_values(df.where("id < 0"), share).count() == 0


def test_values_do_not_move(spark):
    """Nothing but digests is dealt by key before the values of candidates are counted."""
    documents = table(spark, SMALL, "documents")
    df = profile.frequent_values(documents, 0.01)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" not in plan and "Join Inner" in plan  # the sketches are done by then
    cells = profile._cells(documents, documents.columns)
    counted = cells.groupBy("column_name", profile._digest().alias("digest")).count()
    assert all("value" not in line for line in shuffled_texts(counted))


def test_a_publication_body_is_parsed_once(spark):
    df = docs.publication_records(derived.publication_bodies(spark, SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1


def test_publication_problems(spark):
    record = {"sortpubdate": "2024/01/02 00:00", "fulljournalname": "J", "title": "T"}
    bodies = [
        ("broken", '{"result": {"uids": ["1"'),
        ("none", None),
        ("listless", json.dumps({"result": {"1": record}})),
        ("missing", json.dumps({"result": {"uids": ["1", "2", "2"], "2": record}})),
        ("stampless", json.dumps({"result": {"uids": ["$.x'\"]"], "$.x'\"]": {"title": 5}}})),
        ("empty", json.dumps({"result": {"uids": []}})),
        ("odd", json.dumps({"result": {"uids": ["1"], "1": "text"}})),
    ]
    df = spark.createDataFrame(bodies, "file_name string, body string")
    got = [(r.file_name, r.uid, r.stamp, r.title, r.problem) for r in docs.publication_records(df).collect()]
    assert sorted(got, key=str) == sorted([
        ("broken", None, None, None, "body"), ("none", None, None, None, "body"),
        ("listless", None, None, None, "uids"),
        ("missing", "1", None, None, "record"), ("missing", "2", "2024/01/02 00:00", "T", None),
        ("missing", "2", "2024/01/02 00:00", "T", None),
        ("stampless", "$.x'\"]", None, "5", "stamp"), ("odd", "1", None, None, "stamp"),
    ], key=str)
