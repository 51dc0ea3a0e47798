from __future__ import annotations

import json
from datetime import date

import pytest
from conftest import as_set, rows
from pyspark.sql import functions as F

from signalstar.session import scratch_path, shared_folder
from signalstar.sources import documents as docs
from signalstar.sources import population_sheet as sheet
from signalstar.sources import reference_rows as ref
from signalstar.sources.schemas import INTEREST
from signalstar.sources.tables import local_table, read_table, reload_table, save_processed
from signalstar.sources.trends import national_rows, read_trend_lines, regional_rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def trend_file(path, label, header, lines):
    write(path, "Category: All categories\n\n" + f"{label},{header}\n" + "\n".join(lines) + "\n")


def test_national_files_in_one_scan(spark, tmp_path):
    trend_file(tmp_path / "Peptides_AB-1.csv", "Week", "AB-1: (United Kingdom),Peptides: (United Kingdom)",
               ["2023-01-01,3,40", "2023-01-08,<1,41", "2023-01-15,,39"])
    trend_file(tmp_path / "Peptides_zeta.csv", "Week", "zeta: (UK),Peptides: (UK)", ["2023-01-04,9,40"])
    got = as_set(national_rows(read_trend_lines(spark, str(tmp_path / "*.csv"))))
    assert got == {
        ("AB-1", date(2023, 1, 1), 3.0), ("AB-1", date(2023, 1, 8), 0.5),
        ("AB-1", date(2023, 1, 15), None), ("zeta", date(2023, 1, 1), 9.0)}


def test_regional_files(spark, tmp_path):
    for window, first in (("baseline", "4%"), ("current", "<1%")):
        trend_file(tmp_path / f"AB-1_{window}.csv", "Region", f"AB-1: ({window}),Peptides: ({window})",
                   [f"Wales,{first},96%", "England,,100%"])
    got = as_set(regional_rows(read_trend_lines(spark, str(tmp_path / "*.csv"))))
    assert got == {
        ("AB-1", "Wales", "baseline", date(2023, 1, 1), 4.0),
        ("AB-1", "England", "baseline", date(2023, 1, 1), 0.0),
        ("AB-1", "Wales", "current", date(2026, 5, 10), 0.5),
        ("AB-1", "England", "current", date(2026, 5, 10), 0.0)}


def test_exports_in_part_files(spark, tmp_path):
    for folder in ("Peptides_AB-1.csv", "file_name=Peptides_zeta+ x.csv"):
        for n in (1, 2):
            write(tmp_path / folder / f"part-0000{n}.csv", f"Category: All\nWeek,x,y\n2023-01-0{n},{n},9\n")
    got = as_set(national_rows(read_trend_lines(spark, str(tmp_path / "*"))))
    assert got == {(name, date(2023, 1, 1), float(n)) for name in ("AB-1", "zeta+ x") for n in (1, 2)}


def test_bodies_by_line(spark, tmp_path):
    line = json.dumps({"items": [{"timestamp": "2023010100", "views": 5}]})
    write(tmp_path / "AB-1_pageviews.json" / "part-00000.txt", f"{line}\n{line}\nbroken\n")
    got = rows(docs.pageviews(docs.read_bodies(spark, str(tmp_path / "*"), per_line=True)).orderBy("date"))
    assert got == [("AB-1_pageviews.json", None, None)] + 2 * [("AB-1_pageviews.json", date(2023, 1, 1), 5)]


def test_csv_keeps_quotes(spark, tmp_path):
    title = 'A "quoted", \\ title'
    frame = spark.range(1).select(F.lit(title).alias("title"))
    save_processed(frame, str(tmp_path / "t"))
    assert rows(spark.read.csv(str(tmp_path / "t"), header=True, escape='"')) == [(title,)]


def test_news(spark, tmp_path):
    write(tmp_path / "ab-1.json", json.dumps({"articles": [
        {"url": "u", "title": "One", "seendate": "20260609T133000Z", "domain": "a.com", "language": "en"},
        {"title": None, "seendate": "20260610T000000Z", "domain": "b.com"}]}, indent=1))
    bodies = docs.read_bodies(spark, str(tmp_path / "*.json"))
    got = rows(docs.news_articles(bodies).orderBy("pos"))
    assert got == [("ab-1.json", 0, "20260609T133000Z", "a.com", "One"),
                   ("ab-1.json", 1, "20260610T000000Z", "b.com", None)]
    assert rows(bodies.select(docs.entity_of_file(docs.NEWS_SUFFIX))) == [("ab-1",)]


def test_publications_follow_the_uid_list(spark, tmp_path):
    body = {"header": {}, "result": {
        "11": {"uid": "11", "sortpubdate": "2024/01/02 00:00", "fulljournalname": "J", "title": "Later",
               "authors": [{"name": "x"}]},
        "uids": ["22", "11"],
        "22": {"uid": "22", "sortpubdate": "2023/05/06 00:00", "fulljournalname": "K"}}}
    write(tmp_path / "AB-1_summary.json", json.dumps(body, indent=2))
    got = rows(docs.publications(docs.read_bodies(spark, str(tmp_path))).orderBy("pos"))
    assert got == [("AB-1_summary.json", 0, "22", "2023/05/06 00:00", "K", None),
                   ("AB-1_summary.json", 1, "11", "2024/01/02 00:00", "J", "Later")]


def test_pageviews(spark, tmp_path):
    write(tmp_path / "AB-1_pageviews.json", json.dumps({"items": [
        {"timestamp": "2023010100", "views": 5}, {"timestamp": "2023010200", "views": 0}]}))
    got = as_set(docs.pageviews(docs.read_bodies(spark, str(tmp_path))))
    assert got == {("AB-1_pageviews.json", date(2023, 1, 1), 5), ("AB-1_pageviews.json", date(2023, 1, 2), 0)}


def test_population_takes_the_newest_year_of_known_regions(spark, tmp_path):
    write(tmp_path / "p.json", json.dumps({"source": "s", "unit": "persons", "geographies": [
        {"code": "E9", "name": "England", "population_by_year": {"999": 1, "2023": 10, "2024": 11}},
        {"code": "K0", "name": "United Kingdom", "population_by_year": {"2024": 99}}]}))
    got = rows(docs.populations(docs.read_bodies(spark, str(tmp_path)), ["England", "Wales"]))
    assert got == [("E9", "England", 11, "2024")]


def test_population_sheet(spark):
    cells = spark.createDataFrame(
        [("A title", None, None, None, None), (None, None, None, None, None),
         ("Code", "Name", "Geography", "Mid-2023", "Mid-2024"),
         ("E1", "North", "Region", "5", "6"), ("X9", "Parish", "Local", "1", "1"), (None, "note", None, None, None)],
        "_c0 string, _c1 string, _c2 string, _c3 string, _c4 string")
    codes = spark.createDataFrame([("E1", "North East")], "code string, name string")
    places = sheet.places_from_sheet(sheet.with_header(cells), codes)
    assert rows(places) == [("E1", "North East", {"2023": 5, "2024": 6})]
    with pytest.raises(ValueError):
        sheet.with_header(cells.where("_c0 = 'E1'"))


def test_authored_rows(spark):
    entities = rows(ref.entity_rows(spark).orderBy("entity_id"))
    assert [e[0] for e in entities] == list(range(1, 10))
    assert {e[3] for e in entities} == {None} and [e[1] for e in entities if e[4]] == ["Semaglutide"]
    assert rows(ref.source_rows(spark).orderBy("source_id"))[0] == (1, "Google Trends", 7)
    assert rows(ref.region_keys(spark).orderBy("region_id"))[-1] == (4, "Northern Ireland")
    assert ref.place_codes(spark).count() == 5 and ref.place_codes(spark, ref.REGION_PLACES).count() == 12


def test_authored_rows_have_a_known_size(spark):
    plan = ref.source_rows(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation")


def test_reload_replaces_and_counts(spark, tmp_path):
    path = str(tmp_path / "interest")
    df = spark.createDataFrame(
        [(20230101, 1, None, 1, 2.0), (20230108, 1, 2, 2, float("nan"))], INTEREST)
    assert reload_table(df, path) == 2
    assert reload_table(df, path, ["source_id"], ["date_id"]) == 2
    back = read_table(spark, str(tmp_path), "interest")
    assert as_set(back.select("date_id", "region_id", "interest_score")) == {
        (20230101, None, 2.0), (20230108, 2, None)}


def test_processed_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(20230101, 1, None, 1, 2.5)], INTEREST)
    save_processed(df, str(tmp_path / "interest"))
    save_processed(df, str(tmp_path / "interest"))
    assert rows(read_table(spark, str(tmp_path), "interest", "csv")) == [(20230101, 1, None, 1, 2.5)]


def test_local_table_of_no_rows(spark):
    assert local_table(spark, [], INTEREST).count() == 0


class Session:
    """Just what shared_folder reads; the setting is fixed once a session runs."""

    def __init__(self, setting=None, folder=None, master="local[2]"):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_prefers_the_session_setting():
    assert shared_folder(Session("/shared/a")) == "/shared/a"
    assert shared_folder(Session(None, "/shared/b", "spark://x")) == "/shared/b"
    assert scratch_path(Session("/shared/a/"), "x").startswith("/shared/a/x-")
    with pytest.raises(ValueError):
        shared_folder(Session(master="spark://x"))
    local = Session()
    assert "signalstar-" in shared_folder(local) and shared_folder(local) == shared_folder(local)


def test_calendar_and_entity_of_file_need_the_suffix(spark):
    df = spark.createDataFrame([("AB-1_summary.json",), ("AB-1.json",)], "file_name string")
    got = rows(df.select(docs.entity_of_file(docs.PUBLICATION_SUFFIX)))
    assert got == [("AB-1",), ("",)]
