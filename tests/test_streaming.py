from __future__ import annotations

from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import as_set

from signalstar.plans import catalog
from signalstar.streaming import weekly

SCHEMA = "ts timestamp, kind string, value double"


def put(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def counts(spark, folder):
    stream = weekly.arriving(spark, folder, spark.createDataFrame([], SCHEMA).schema)
    return weekly.weekly_counts(stream, "ts", ["kind"], "value")


def run(spark, folder, out, mark):
    weekly.append_closed_weeks(counts(spark, folder), out, mark).awaitTermination()
    return as_set(spark.read.schema("week date, kind string, n_events bigint, total double").parquet(out))


def test_weeks_are_appended_once_they_are_closed(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    put(spark, folder, [(datetime(2023, 1, 1, 0), "a", 1.0), (datetime(2023, 1, 7, 23), "a", 2.0),
                        (datetime(2023, 1, 8), "b", 5.0)])
    assert run(spark, folder, out, mark) == set()
    # A later file adds to an open week, and its own date closes the first two.
    put(spark, folder, [(datetime(2023, 1, 9), "b", 4.0), (datetime(2023, 1, 22), "a", 9.0)])
    first, second = (date(2023, 1, 1), "a", 2, 3.0), (date(2023, 1, 8), "b", 2, 9.0)
    assert run(spark, folder, out, mark) == {first, second}
    assert run(spark, folder, out, mark) == {first, second}


def test_late_rows_are_counted(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    put(spark, folder, [(datetime(2023, 1, 1), "a", 1.0), (datetime(2023, 2, 1), "a", 2.0)])
    run(spark, folder, out, mark)
    late = [(datetime(2023, 1, 2), "a", 3.0), (datetime(2023, 1, 3), "a", 3.0), (datetime(2023, 1, 4), "b", 3.0)]
    put(spark, folder, late)
    query = weekly.append_closed_weeks(counts(spark, folder), out, mark)
    query.awaitTermination()
    assert weekly.late_groups(query) == 2


@pytest.fixture
def event_tables(spark, tmp_path):
    """Events in eight files, with their customers and nations."""
    folder = str(tmp_path / "tables")
    events = [(i, datetime(2024, 1, 1) + timedelta(hours=i), i % 7, ("view", "error")[i % 2],
               float(i % 90), f"title {i % 5}") for i in range(960)]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).repartition(8).write.parquet(f"{folder}/events.parquet")
    customers = [(i, f"C{i}", i % 2, 1.0, ("BUILDING", "MACHINERY")[i % 2]) for i in range(7)]
    spark.createDataFrame(
        customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ).write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, "A", 1), (1, "B", 2)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(
        f"{folder}/nation.parquet")
    return folder


@pytest.mark.parametrize("query, batch", [
    ("stream_pageview_index", "fact_pageviews"),
    ("stream_event_rollup", "fact_event_rollup"),
    ("load_incremental_events", "fact_event_rollup"),
])
def test_no_delivery_goes_through_one_task(spark, tmp_path, monkeypatch, event_tables, query, batch):
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name))
    found = catalog.QUERIES[query](spark, event_tables)
    whole = catalog.QUERIES[batch](spark, event_tables)
    same = [c for c in found.columns if c in whole.columns]
    assert len(same) >= 3
    assert as_set(found.select(same)) == as_set(whole.select(same))
    assert found.count() == whole.count() > 1
    files = [pq.read_metadata(f).num_rows for f in tmp_path.glob("*/raw/*.parquet")]
    assert sum(n > 0 for n in files) > 3 and max(files) < sum(files) / 4
