"""Raw files to answers, on hand-made files whose figures were worked out by hand."""

from __future__ import annotations

import json
from datetime import date, timedelta

import pytest
from conftest import as_set, rows

from signalstar.operators import growth, spikes
from signalstar.operators.quality import QualityError, enforce
from signalstar.plans import raw_star as R
from signalstar.plans.star import Star
from signalstar.plans.warehouse import load_star
from signalstar.sources import reference_rows as ref
from signalstar.sources.tables import read_table, reload_table

FIRST = date(2023, 1, 1)
REGIONS = ["England", "Scotland", "Wales", "Northern Ireland"]


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def trend(path, label, lines):
    put(path, f"Category: All categories\n\n{label},own: (x),Peptides: (x)\n" + "\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    weekly = {
        # 13 weeks of <1, then 4, then 13 weeks of 8 with a tie at the peak of 9
        "BPC-157": ["<1"] * 13 + ["4"] * 4 + ["8"] * 11 + ["9", "9"],
        "TB-500": ["0"] * 13 + ["1"] * 17,
    }
    for name, scores in weekly.items():
        trend(root / "national" / f"Peptides_{name}.csv", "Week",
              [f"{FIRST + timedelta(days=7 * n)},{s},50" for n, s in enumerate(scores)])
        for window, cells in (("baseline", ["4%", "<1%", "", "0%"]), ("current", ["6%", "3%", "1%", "<1%"])):
            order = REGIONS if window == "baseline" else REGIONS[::-1]
            pairs = dict(zip(REGIONS, cells))
            trend(root / "regional" / f"{name}_{window}.csv", "Region", [f"{r},{pairs[r]},90%" for r in order])
    articles = [("20230102T000000Z", "a.com", None), ("20230103T120000Z", "a.com", "Second"),
                ("20230107T235959Z", "b.com", "Third"), ("20230108T000000Z", "b.com", "Fourth")]
    put(root / "news" / "bpc-157.json", json.dumps({"articles": [
        {"seendate": s, "domain": d, "title": t} for s, d, t in articles]}))
    papers = {"5": ("2022/12/31 00:00", "J", "too early"), "6": ("2027/01/02 00:00", "J", "last week"),
              "7": ("2023/01/04 00:00", "K", "kept"), "8": ("2023/01/05 00:00", "K", "kept too")}
    put(root / "papers" / "tb-500_summary.json", json.dumps({"result": {
        "uids": ["8", "7", "6", "5"],
        **{u: {"sortpubdate": s, "fulljournalname": j, "title": t} for u, (s, j, t) in papers.items()}}}))
    views = {"items": [{"timestamp": f"{FIRST + timedelta(days=n):%Y%m%d}00", "views": n} for n in range(14)]}
    put(root / "views" / "TB-500_pageviews.json", json.dumps(views))
    put(root / "people.json", json.dumps({"source": "s", "unit": "persons", "geographies": [
        {"code": "K0", "name": "United Kingdom", "population_by_year": {"2024": 10}}] + [
        {"code": str(n), "name": r, "population_by_year": {"2023": 1, "2024": 1_000_000 * (n + 1)}}
        for n, r in enumerate(REGIONS)]}))
    return root


@pytest.fixture(scope="module")
def star(spark, raw):
    two = [e for e in ref.ENTITY_INFO if e[0] in ("BPC-157", "TB-500")]
    return R.raw_star(spark, R.RawPaths(
        national=f"{raw}/national/*.csv", regional=f"{raw}/regional/*.csv", news=f"{raw}/news",
        publications=f"{raw}/papers", pageviews=f"{raw}/views", population=f"{raw}/people.json"),
        entities=ref.entity_rows(spark, two))


def test_fact_rows(star):
    # 2 x 30 weeks, 2 x 2 x 4 snapshots, 2 weeks of page views
    assert star.interest.count() == 60 + 16 + 2
    views = star.interest.where("source_id = 4").orderBy("date_id").select("date_id", "interest_score")
    assert rows(views) == [(20230101, 21 / 70 * 100), (20230108, 100.0)]
    assert as_set(star.events) == {
        (FIRST, 3, 2, "News/Media", "Second", None, 1),
        (FIRST + timedelta(days=7), 1, 1, "News/Media", "Fourth", None, 1),
        (FIRST, 2, 1, "Clinical research", "kept too", None, 2),
        (date(2026, 12, 27), 1, 1, "Clinical research", "last week", None, 2)}
    assert [r[2] for r in rows(star.regions.orderBy("region_id"))] == [10**6, 2 * 10**6, 3 * 10**6, 4 * 10**6]


def test_reports_pass(star):
    enforce(R.interest_report(star, expected_regional=16))
    enforce(R.event_report(star))
    enforce(R.dimension_report(star, expected_regions=4))


def test_wrong_expectation_fails(star):
    with pytest.raises(QualityError, match="regional_row_count"):
        enforce(R.interest_report(star, expected_regional=72))


def test_growth_by_hand(star):
    """The newest trend rows are the regional ones of 2026-05-10, so that week alone is
    the current window; the baseline holds 13 weeks and 4 regional rows of each entity."""
    got = {r[0]: r[1:] for r in rows(growth.entity_growth(star, "Google Trends"))}
    current = (6 + 3 + 1 + 0.5) / 4
    regional = 4 + 0.5
    base = {"BPC-157": (13 * 0.5 + regional) / 17, "TB-500": regional / 17}
    for name, b in base.items():
        assert got[name] == (round(b, 2), round(current + 1e-9, 2), round(100 * (current - b) / b, 2))


def test_national_growth_by_hand(star):
    got = rows(growth.entity_growth(star, "Google Trends", national_only=True))
    late = (11 * 8 + 2 * 9) / 13
    assert got == [("BPC-157", 0.5, round(late, 2), round(100 * (late - 0.5) / 0.5, 2)), ("TB-500", 0.0, 1.0, None)]


def test_published_growth(spark, tmp_path):
    """13 weeks of 0 and regions of 0.5, 0, 0, 0, then 13 weeks that sum to 21: 5,392.31 %.
    The current snapshot's week, 2026-05-10, is before the last 90 days."""
    scores = ["0"] * 13 + ["1"] * 163 + list("1111133222211")
    weeks = [FIRST + timedelta(days=7 * n) for n in range(len(scores))]
    assert weeks[-1] == date(2026, 8, 9)
    trend(tmp_path / "national" / "Peptides_TB-500.csv", "Week",
          [f"{w},{s},50" for w, s in zip(weeks, scores)])
    for window, cells in (("baseline", ["<1%", "", "0%", ""]), ("current", ["9%"] * 4)):
        trend(tmp_path / "regional" / f"TB-500_{window}.csv", "Region",
              [f"{r},{c},90%" for r, c in zip(REGIONS, cells)])
    put(tmp_path / "news" / "tb-500.json", '{"articles": []}')
    star = R.raw_star(spark, R.RawPaths(
        national=f"{tmp_path}/national", regional=f"{tmp_path}/regional", news=f"{tmp_path}/news"))
    assert rows(growth.entity_growth(star, "Google Trends")) == [("TB-500", 0.03, 1.62, 5392.31)]


def test_region_growth_by_hand(star):
    assert rows(growth.region_growth(star)) == [
        ("Scotland", 0.5, 3.0, 500.0), ("England", 4.0, 6.0, 50.0),
        ("Northern Ireland", 0.0, 0.5, None), ("Wales", 0.0, 1.0, None)]


def test_peak_is_the_latest_of_a_tie(star):
    got = {r[0]: r[1:3] for r in rows(spikes.largest_spikes(star, "Google Trends"))}
    assert got["BPC-157"] == (FIRST + timedelta(days=7 * 29), 9.0)
    assert got["TB-500"] == (date(2026, 5, 10), 6.0)


def test_load_and_read_back(spark, star, tmp_path):
    checks = {"interest": R.interest_report, "events": R.event_report}
    folder = str(tmp_path / "star")
    counts = load_star(spark, star, folder, checks)
    assert counts == {"entities": 2, "regions": 4, "sources": 5, "dates": 209, "interest": 78, "events": 4}
    assert load_star(spark, star, folder, checks) == counts
    back = Star.read(spark, folder)
    assert rows(growth.region_growth(back)) == rows(growth.region_growth(star))


def test_a_failed_check_leaves_the_table(spark, star, tmp_path):
    folder = str(tmp_path / "star")
    load_star(spark, star, folder)
    worse = star.but(interest=star.interest.selectExpr(
        "date_id", "entity_id", "region_id", "source_id", "interest_score + 100 AS interest_score"))
    with pytest.raises(QualityError, match="interest_score: within"):
        load_star(spark, worse, folder, {"interest": R.interest_report})
    assert Star.read(spark, folder).interest.agg({"interest_score": "max"}).first()[0] == 100.0


def test_unknown_entity_is_reported(spark, star, raw):
    other = R.raw_star(spark, R.RawPaths(
        national=f"{raw}/national/*.csv", regional=f"{raw}/regional/*.csv", news=f"{raw}/news"),
        entities=ref.entity_rows(spark, [e for e in ref.ENTITY_INFO if e[0] == "TB-500"]))
    with pytest.raises(QualityError, match="entity_id: no_nulls fails 38 time"):
        enforce(R.interest_report(other))
    with pytest.raises(ValueError):
        R.raw_star(spark, R.RawPaths(news=f"{raw}/news"))


def test_one_trend_source_is_enough(spark, raw):
    entities = ref.entity_rows(spark, [e for e in ref.ENTITY_INFO if e[0] in ("BPC-157", "TB-500")])
    paths = {"news": f"{raw}/news", "population": f"{raw}/people.json"}
    regional = R.raw_star(spark, R.RawPaths(regional=f"{raw}/regional/*.csv", **paths), entities)
    assert regional.interest.count() == 16
    national = R.raw_star(spark, R.RawPaths(national=f"{raw}/national/*.csv", **paths), entities)
    assert national.interest.count() == 60


@pytest.mark.parametrize("broken,report,message", [
    ("news", R.event_report, "event_date: no_nulls"),
    ("record", R.event_report, "event_date: no_nulls"),
    ("stamp", R.event_report, "event_date: no_nulls"),
    ("views", R.interest_report, "date_id: no_nulls"),
    ("label", R.interest_report, "date_id: no_nulls"),
    ("region", R.interest_report, "region_id: foreign_key"),
])
def test_unreadable_input_is_never_lost(spark, tmp_path, broken, report, message):
    trend(tmp_path / "national" / "Peptides_TB-500.csv", "Week",
          ["2023-01-01,5,1", ",7,1" if broken == "label" else "2023-01-08,7,1"])
    trend(tmp_path / "regional" / "TB-500_current.csv", "Region",
          ["England,5%,9%", ",6%,9%" if broken == "region" else "Wales,6%,9%"])
    body = json.dumps({"articles": [{"seendate": "20230102T000000Z", "domain": "a", "title": "T"}]})
    put(tmp_path / "news" / "TB-500.json", body)
    put(tmp_path / "news" / "BPC-157.json", body[:30] if broken == "news" else body)
    record = {"sortpubdate": "soon" if broken == "stamp" else "2023/01/04 00:00",
              "fulljournalname": "J", "title": "T"}
    put(tmp_path / "papers" / "TB-500_summary.json", json.dumps({"result": {
        "uids": ["7"], **({} if broken == "record" else {"7": record})}}))
    views = json.dumps({"items": [{"timestamp": "2023010100", "views": 3}]})
    put(tmp_path / "views" / "TB-500_pageviews.json", views[:20] if broken == "views" else views)
    put(tmp_path / "people.json", json.dumps({"geographies": [
        {"code": str(n), "name": r, "population_by_year": {"2024": 5}} for n, r in enumerate(REGIONS)]}))
    star = R.raw_star(spark, R.RawPaths(
        national=f"{tmp_path}/national", regional=f"{tmp_path}/regional", news=f"{tmp_path}/news",
        publications=f"{tmp_path}/papers", pageviews=f"{tmp_path}/views",
        population=f"{tmp_path}/people.json"))
    with pytest.raises(QualityError, match=message):
        enforce(report(star))


def test_two_files_of_one_entity_give_one_title(spark, tmp_path):
    for name, title in (("TB-500", "later"), ("tb-500", "earlier")):
        put(tmp_path / f"{name}.json", json.dumps({"articles": [
            {"seendate": "20230102T000000Z", "domain": name, "title": title}]}))
    bodies = R.docs.read_bodies(spark, str(tmp_path))
    rows_ = R.docs.news_articles(bodies).withColumn("entity_name", R.docs.entity_of_file(".json"))
    got = R.news_facts(rows_, ref.entity_rows(spark)).collect()
    assert [(r.related_article_count, r.source_count, r.title) for r in got] == [(2, 2, "earlier")]


def test_orphans_are_refused_without_being_asked(spark, star, tmp_path):
    short = star.but(entities=star.entities.where("entity_name <> 'TB-500'"))
    with pytest.raises(QualityError, match="entity_id: foreign_key fails 1 time"):
        load_star(spark, short, str(tmp_path / "star"))


def test_a_lost_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert reload_table(spark.range(5), path) == 5
    broken = spark.range(9).selectExpr("IF(id = 8, raise_error('lost'), id) AS id")
    with pytest.raises(Exception, match="lost"):
        reload_table(broken, path)
    again = read_table(spark, str(tmp_path), "t")
    assert again.count() == 5
    assert reload_table(again.unionByName(again), path) == 10
    assert read_table(spark, str(tmp_path), "t").count() == 10
