"""Reader-facing texts, ranges, calendar fields and the run log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listweave.functions import prices, text, timeparse
from listweave.operators import display, extract, merge, present, state



def today():
    return F.lit("2026-08-20").cast("date")  # a Thursday


def of(spark, column):
    return spark.range(1).select(column.alias("r")).first()["r"]


def day(value):
    return F.lit(value).cast("date")


@pytest.mark.parametrize(
    ("value", "time", "label"),
    [
        ("2026-08-20", "", "ma, augusztus 20."),
        ("2026-08-21", "09:00", "holnap, augusztus 21., 09:00"),
        ("2026-09-02", "19:00", "szerda, szeptember 2., 19:00"),
        ("2026-08-19", "", "szerda, augusztus 19."),
    ],
)
def test_when_label(spark, value, time, label):
    assert of(spark, display.when_label(day(value), today(), F.lit(time))) == label


def test_labels(spark):
    assert of(spark, display.category_label(F.lit("szinhaz"))) == "Színház"
    assert of(spark, display.category_label(F.lit("new"))) == "new"
    assert of(spark, display.full_date(day("2026-08-22"))) == "2026. augusztus 22."
    assert [of(spark, display.score_bar(F.lit(x))) for x in (-3.0, 0.0, 0.1, 2.0, 13.0, 99.0)] == [0, 0, 1, 1, 7, 7]
    assert of(spark, display.price_label(F.lit(False), F.lit(1234567))) == "1 234 567 Ft"
    assert of(spark, display.price_label(F.lit(True), F.lit(None).cast("long"))) == "ingyenes"
    assert of(spark, display.price_label(F.lit(False), F.lit(None).cast("long"))) == "ár nincs megadva"
    late = F.lit("2026-08-22 01:30:00").cast("timestamp_ntz")
    assert of(spark, display.night_note(late, day("2026-08-21"))) == "éjjel, szombatra"
    assert of(spark, display.night_note(late, day("2026-08-22"))) is None
    assert of(spark, display.meta_text(F.lit(""), F.lit("XI."), F.lit("ingyenes"))) == "XI. kerület · ingyenes"
    assert of(spark, display.meta_text(F.lit("Hall"), F.lit(None).cast("string"), F.lit("5 Ft"))) == "Hall · 5 Ft"


def test_subject_and_missing_labels(spark):
    rows = spark.createDataFrame([(["film", "odd"],), (["odd"],)], "categories array<string>")
    assert [tuple(r) for r in display.unlabelled(rows).collect()] == [("odd", 2)]
    assert display.subject(rows, today()).first()["subject"] == "Budapest — 2026. augusztus 20.: 2 új program"
    assert display.subject(rows.limit(0), today()).first()["subject"] == "Budapest — 2026. augusztus 20.: ma nincs semmi"


def test_date_range(spark):
    days = [dt.date(2026, 8, 19) + dt.timedelta(k) for k in range(11)]
    rows = spark.createDataFrame([(x,) for x in [*days, None]], "effective_date date")
    shown = lambda name: [r[0].day for r in rows.filter(present.date_range(name, today())).collect() if r[0]]
    assert shown("today") == [20] and shown("tomorrow") == [21]
    assert shown("week") == list(range(20, 28)) and shown("weekend") == [21, 22, 23]
    assert rows.filter(present.date_range("all", today())).count() == 12


@pytest.mark.parametrize(
    ("raw", "plain"),
    [
        ("Come!\n\nJoin with Google Meet\nhttps://x", "Come!"),
        ("csatlakozás a google meet SZOLGÁLTATÁSSAL: x", None),
        ("a<br>b &amp; <a href='x'>c</a>", "a b & c"),
        ("a &amp; b", "a &amp; b"),
        ("Join with Google Meeting", "Join with Google Meeting"),
        (None, None),
        (" \n ", None),
    ],
)
def test_calendar_description(spark, raw, plain):
    assert of(spark, extract.calendar_description(F.lit(raw).cast("string"))) == plain


@pytest.mark.parametrize(
    ("location", "venue", "zip_code"),
    [
        ("Club – Budapest, Fo u. 18, 1124 Hungary", "Club", "1124"),
        ("1000 x, 1243, 12345, 1052 Budapest", "1000 x", "1052"),
        ("", None, None),
        ("- Budapest, 6720 Szeged", None, None),
    ],
)
def test_calendar_place(spark, location, venue, zip_code):
    assert of(spark, extract.calendar_venue(F.lit(location))) == venue
    assert of(spark, extract.calendar_zip(F.lit(location))) == zip_code


@pytest.mark.parametrize(("url", "category"), [("https://x.hu/a/film/3?b/c", "film"), ("https://x.hu/a", None), ("//x.hu//a//b/", "b"), ("a/b#c", "b"), ("", None)])
def test_url_category(spark, url, category):
    assert of(spark, text.url_category(F.lit(url))) == category


def test_strip_venue_suffix(spark):
    rows = [("Quiz | A38 Hajó", "A38 Hajó"), ("A38 | Koncert X", "A38"), ("Quiz - A38 hajo", "A38 Hajó"), ("Quiz", "A38"), ("Quiz | A38", None), ("Quiz | A38", " ")]
    found = spark.createDataFrame(rows, "t string, v string").select(merge.strip_venue_suffix("t", "v").alias("r"))
    assert [r[0] for r in found.collect()] == ["Quiz", "A38 | Koncert X", "Quiz", "Quiz", "Quiz | A38", "Quiz | A38"]


def test_kept_runs(spark):
    log = spark.range(50).withColumnRenamed("id", "seq")
    assert sorted(r[0] for r in state.kept_runs(log, "seq").collect()) == list(range(20, 50))
    assert state.kept_runs(log.limit(0), "seq").count() == 0


def test_split_fields(spark):
    start = F.lit("2024-01-10 19:00:00").cast("timestamp_ntz")
    assert of(spark, timeparse.resolve_year(F.lit(" - 01. 02. 03:04"), start)) == "2025-01-02 03:04:00"
    assert of(spark, timeparse.resolve_year(F.lit("08. 21. 23:59"), start)) == "2024-08-21 23:59:00"
    assert of(spark, timeparse.resolve_year(F.lit("02. 29. 10:00"), start)) is None
    assert of(spark, timeparse.combine_start(F.lit("2026-08-22T12:00:00.000Z"), F.lit(" 9:05"))) == "2026-08-22 09:05:00"
    assert of(spark, timeparse.combine_start(F.lit("2026-08-22"), F.lit("19:00"))) is None
    assert of(spark, prices.price_from_parts(F.lit("0"), F.lit(None).cast("string"))) == "0 HUF"
    assert of(spark, prices.price_from_parts(F.lit(""), F.lit("EUR"))) is None
