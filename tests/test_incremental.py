"""Inputs that come bit by bit: incremental loads, streams that correct weeks, spread ranks."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from signalstar.operators import ranking
from signalstar.operators.facts import event_rollup, own_peak_index, weekly_totals
from signalstar.plans import incremental
from signalstar.sources import snapshots
from signalstar.streaming import pageviews, rollup

ARTICLES = ("entity_id int, week date, region_id int, category string, publisher string, "
            "title string, pos long")


def article_rows(seed, n=60, weeks=6):
    random_ = random.Random(seed)
    return [
        (random_.randrange(3), random_.choice([None, *(date(2024, 1, 7) + timedelta(7 * w) for w in range(weeks))]),
         random_.choice([None, 1, 2]), random_.choice(["news", "paper"]),
         random_.choice([None, *"abcdefgh"]), random_.choice([None, f"t{i}"]), random_.randrange(1000))
        for i in range(n)
    ]


def put(spark, folder, rows):
    spark.createDataFrame(rows, ARTICLES).coalesce(1).write.mode("append").parquet(folder)


def inputs(spark, folder):
    return spark.read.schema(ARTICLES).parquet(folder).select("*", incremental.input_name().alias("input"))


def take(spark, raw, out):
    return incremental.take_articles(spark, out, inputs(spark, raw))


def whole(spark, raw):
    return as_set(event_rollup(spark.read.schema(ARTICLES).parquet(raw)))


def test_only_changed_weeks_are_made_anew(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    put(spark, raw, article_rows(1))
    assert len(take(spark, raw, out)) == 7
    files = set(spark.read.parquet(f"{out}/events").inputFiles())
    late = [(1, date(2024, 1, 14), 1, "news", "z", "first of all", -1)]
    put(spark, raw, late)
    assert take(spark, raw, out) == ["2024-01-14"]
    kept = files & set(spark.read.parquet(f"{out}/events").inputFiles())
    assert not [f for f in files - kept if "2024-01-14" not in f]
    assert as_set(incremental.rolled_up(spark, out)) == whole(spark, raw)
    assert take(spark, raw, out) == []
    assert [r.title for r in incremental.rolled_up(spark, out).where(
        "entity_id = 1 AND region_id = 1 AND category = 'news' AND event_date = '2024-01-14'"
    ).collect()] == ["first of all"]


@pytest.mark.parametrize("lost", ["staged", "inputs", "weeks", "done"])
def test_a_lost_run_is_run_again(spark, tmp_path, monkeypatch, lost):
    """Stopped while staging, before publishing, before the weeks, and before the last mark."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    put(spark, raw, article_rows(2))
    take(spark, raw, out)
    put(spark, raw, article_rows(3, 5, 2))
    published = []

    def write(df, path, *rest):
        if lost == "staged" and "staged" in path or lost == "inputs" and "/inputs/" in path:
            raise KeyboardInterrupt
        return real_write(df, path, *rest)

    def publish(*args):
        published.append(1)
        if lost == "done" and len(published) == 2:
            raise KeyboardInterrupt
        return real_publish(*args)

    def overwrite(*args):
        if lost == "weeks":
            raise KeyboardInterrupt
        return real_overwrite(*args)

    real_write, real_publish = incremental.write_observed, snapshots.publish
    real_overwrite = incremental.overwrite_weeks
    monkeypatch.setattr(incremental, "write_observed", write)
    monkeypatch.setattr(incremental.snapshots, "publish", publish)
    monkeypatch.setattr(incremental, "overwrite_weeks", overwrite)
    with pytest.raises(KeyboardInterrupt):
        take(spark, raw, out)
    monkeypatch.undo()
    assert take(spark, raw, out) != []
    assert as_set(incremental.rolled_up(spark, out)) == whole(spark, raw)
    assert take(spark, raw, out) == []


def test_no_articles(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    put(spark, raw, [])
    assert take(spark, raw, out) == []


def streamed(spark, raw, out, mark):
    stream = spark.readStream.schema(ARTICLES).option("maxFilesPerTrigger", 1).parquet(raw)
    rollup.follow_articles(stream, out, mark).awaitTermination()
    return as_set(incremental.rolled_up(spark, out))


@pytest.mark.parametrize("parts", [1, 4])
def test_a_stream_corrects_weeks(spark, tmp_path, parts):
    """However the rows are split over files and runs, also where old weeks come last."""
    raw, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))
    rows = sorted(article_rows(4), key=lambda r: r[1] or date.min, reverse=True)
    for k in range(parts):
        put(spark, raw, rows[k::parts] if k else rows[::parts])
        if k == 1:
            streamed(spark, raw, out, mark)
    assert streamed(spark, raw, out, mark) == whole(spark, raw)
    assert streamed(spark, raw, out, mark) == whole(spark, raw)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    out = str(tmp_path / "out")
    batches = [spark.createDataFrame(article_rows(s), ARTICLES) for s in (5, 6)]
    for batch in (0, 1, 1, 0):
        rollup.merge_batch(batches[batch], batch, out)
    assert as_set(incremental.rolled_up(spark, out)) == as_set(event_rollup(batches[0].unionByName(batches[1])))
    rollup.merge_batch(batches[0].limit(0), 2, out)
    assert incremental.rolled_up(spark, out).count() == event_rollup(batches[0].unionByName(batches[1])).count()


def test_many_publishers_within_the_stated_error(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(60_000).selectExpr(
        "1 AS entity_id", "DATE'2024-01-07' AS week", "CAST(NULL AS INT) AS region_id", "'news' AS category",
        "CAST(id % 40000 AS STRING) AS publisher", "CAST(id AS STRING) AS title", "id AS pos")
    for batch in (0, 1):
        rollup.merge_batch(rows.where(F.col("pos") % 2 == batch), batch, out)
    got = incremental.rolled_up(spark, out).first()
    assert (got.related_article_count, got.title) == (60_000, "0")
    assert abs(got.source_count - 40_000) < 5 * rollup.SKETCH_ERROR * 40_000


VIEWS = "entity_id int, date date, views long"


def view_rows(seed, n=150):
    random_ = random.Random(seed)
    return [(random_.choice([None, 1, 2, 3]), date(2024, 1, 7) + timedelta(random_.randrange(40)),
             random_.choice([None, 0, random_.randrange(500)])) for _ in range(n)]


@pytest.mark.parametrize("order", ["as it comes", "rising", "falling"])
def test_streamed_index_equals_batch(spark, tmp_path, order):
    """Whatever comes first: a new peak changes all weeks of its entity, and only those."""
    raw, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))
    rows = view_rows(7) + [(4, date(2024, 1, 8), 0)]
    if order != "as it comes":
        rows.sort(key=lambda r: r[2] or 0, reverse=order == "falling")
    for k in range(3):
        part = rows[k * 50 : (k + 1) * 50] if k < 2 else rows[100:]
        spark.createDataFrame(part, VIEWS).coalesce(1).write.mode("append").parquet(raw)
        if k == 1:
            run_views(spark, raw, out, mark)
    run_views(spark, raw, out, mark)
    run_views(spark, raw, out, mark)
    daily = spark.read.schema(VIEWS).parquet(raw)
    want = own_peak_index(weekly_totals(daily, "date", "views")).select("entity_id", "date", "weekly_total", "interest_score")
    assert as_set(pageviews.page_view_index(spark, out).select(want.columns)) == as_set(want)


def run_views(spark, raw, out, mark):
    stream = spark.readStream.schema(VIEWS).option("maxFilesPerTrigger", 1).parquet(raw)
    pageviews.follow_views(stream, out, mark).awaitTermination()


def test_other_entities_are_left_alone(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([(e, date(2024, 1, 7), 5) for e in range(40)], VIEWS)
    pageviews.merge_views(rows, 0, out)
    files = set(pageviews.page_view_index(spark, out).inputFiles())
    for batch in (1, 1):
        pageviews.merge_views(rows.where("entity_id = 3").selectExpr("entity_id", "date_add(date, 7) AS date", "20L AS views"), batch, out)
    assert len(files - set(pageviews.page_view_index(spark, out).inputFiles())) == 1
    assert as_set(pageviews.page_view_index(spark, out).where("entity_id = 3").select("date", "interest_score")) == {
        (date(2024, 1, 7), 25.0), (date(2024, 1, 14), 100.0)}


@pytest.mark.parametrize("values", [[5.0, 1.0, 5.0, None, 3.0, None, 3.0, 3.0], [], [None], [2.0] * 50])
def test_ranks(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(3)
    got = {r.id: r.rank for r in ranking.ranked(df, "v").collect()}
    size = lambda v: float("-inf") if v is None else v
    assert got == {i: 1 + sum(size(w) > size(v) for w in values) for i, v in enumerate(values)}


def test_ranks_need_no_single_task(spark):
    df = spark.range(20_000).selectExpr("id", "CAST(hash(id) % 5000 AS DOUBLE) AS v")
    found = ranking.ranked(df, "v")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    assert found.groupBy("rank").agg(F.count_distinct("v").alias("n")).where("n > 1").count() == 0
    assert found.agg(F.max("rank")).first()[0] <= 20_000
