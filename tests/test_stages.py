"""Stages on small odd tables: cleaning, mappings, order, keyword tables, state, the stream."""

import datetime as dt
import html
import random
import re
from urllib.parse import urljoin

from pyspark.sql import functions as F

from listweave import catalog, testview
from listweave.config import Settings
from listweave.functions import places, text, timeparse
from listweave.operators import assist, normalize, rank, sources, state


def test_descriptions_are_cut_as_if_cleaned_whole(spark):
    rng = random.Random(1)
    pieces = ["word", " ", "  \n", "&amp;", "&lt;b", "&eacute;", "x" * 90, " " * 300, "&#32;", "&"]
    rows = ["".join(rng.choices(pieces, k=rng.choice([3, 60, 900]))) for _ in range(150)] + ["", None, " " * 5000, "y" * 5000, "a " * 3000]
    frame = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, d string").withColumn("e", text.enough_of("d", 40))
    for r in frame.withColumn("c", text.clean_description("e", 40)).collect():
        plain = " ".join(html.unescape(r.d).split()) if r.d is not None else ""
        head = plain[:40]
        want = plain if len(plain) <= 40 else (head[: head.rindex(" ")] if " " in head else head).rstrip()
        assert r.c == (want or None), r.d


def test_absolute_urls_are_those_of_the_standard_library(spark):
    base = "https://ex.com/a/b?x=1#f"
    links = ["http://o.hu/p", "/c", "c", "../c", "?q=1", "#t", "//o.hu/x", "/a/../b", "mailto:x@y.hu", "https://ex.com/a/../b", "", "/./x"]
    rows = spark.createDataFrame([(base, x) for x in links], "base string, link string").withColumn("url", sources.absolute_url(F.col("link"), F.col("base")))
    assert {r.link: r.url for r in rows.collect()} == {x: urljoin(base, x) for x in links}


def test_transforms(spark):
    steps = ["html_unescape", "strip", "lower", r"regex:(\d+) ft:1", "truncate:3"]
    rows = spark.createDataFrame([(" 12345 FT ",), ("No &amp; Yes",), (None,)], "v string")
    assert [r.v for r in rows.select(sources.transformed(F.col("v"), steps, F.lit("")).alias("v")).collect()] == ["123", "no ", None]


def test_numbering_is_global(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), rng.randint(0, 5), k) for k in range(500)]
    frame = spark.createDataFrame(rows, "s string, n int, k int")
    key = lambda r: ("" if r[0] is None else "x" + r[0], -r[1], r[2])
    want = {r[2]: place for place, r in enumerate(sorted(rows, key=key), 1)}
    assert {r.k: r.ord for r in sources.numbered(frame, ["s", "n", "k"], [False, True, False]).collect()} == want
    assert sources.numbered(frame.limit(0), ["k"]).count() == 0


def test_united_sources_keep_all_columns(spark):
    a = spark.createDataFrame([("s1", 1, 0, "x"), ("s1", 0, 1, "y")], "source_id string, capture int, position int, v string")
    b = spark.createDataFrame([("s0", 5, 0, 7)], "source_id string, capture int, position int, w int")
    assert [(r.ord, r.source_id, r.v, r.w) for r in sources.united([a, b]).orderBy("ord").collect()] == [(1, "s0", None, 7), (2, "s1", "y", None), (3, "s1", "x", None)]


def test_keyword_tables_equal_single_keywords(spark):
    texts = ["jazz koncert a klubban", "c++ est", "#jazz!", "jazzy", "ujazz", "", "a  jazz   koncert", "kon"]
    words = ["jazz", "jazz*", "jazz$", "koncert", "jazz koncert", "c++", "++", "#jazz", "kon*", "", "*"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "key int, haystack string")
    found = {tuple(r) for r in rank.keyword_matches(frame, spark.createDataFrame([(w,) for w in words], "keyword string")).collect()}
    flags = frame.select("key", *[text.contains_word(F.col("haystack"), w).alias(f"w{j}") for j, w in enumerate(words)]).collect()
    assert found == {(r.key, w) for r in flags for j, w in enumerate(words) if r[f"w{j}"]}


def test_health_rules(spark):
    today = dt.date(2024, 1, 10)
    before = spark.createDataFrame([("works", 3, None, 20, today), ("fails", 4, None, 20, None), ("empty", 0, None, 11, None), ("skipped", 6, None, 5, dt.date(2024, 1, 15))], "source_id string, consecutive_failures int, last_ok date, last_count long, disabled_until date")
    run = spark.createDataFrame([("works", 9), ("fails", None), ("empty", 0), ("new", 2)], "source_id string, n long")
    out = {r.source_id: tuple(r)[1:] for r in state.health(before, run, F.lit(today)).collect()}
    assert out == {
        "works": (0, today, 9, None, False), "fails": (5, None, 20, dt.date(2024, 1, 17), False), "empty": (0, today, 0, None, True),
        "new": (0, today, 2, None, False), "skipped": (6, None, 5, dt.date(2024, 1, 15), False),
    }
    assert {r.source_id for r in state.due(before, F.lit(today)).collect()} == {"works", "fails", "empty"}


def test_ledger_keeps_running_listings(spark):
    shown = spark.createDataFrame([("a", "t", dt.date(2024, 1, 9), dt.datetime(2024, 1, 12)), ("b", "u", dt.date(2024, 1, 9), None)], "id string, title_norm string, effective_date date, end timestamp_ntz")
    none = spark.createDataFrame([], "id string, t string, d date, s date, u date")
    twice = state.recorded(state.recorded(none, shown, F.lit(dt.date(2024, 1, 9))), shown, F.lit(dt.date(2024, 1, 9)))
    assert twice.count() == 4
    assert {r.id for r in state.purged(twice, F.lit(dt.date(2024, 1, 10))).collect()} == {"a"}


def test_answers_are_read_with_and_without_fences(spark):
    rows = [(0, '```json\n{"a": "music", "b": 3}\n```'), (1, '{"c": "x"}'), (2, "[1]"), (3, "sorry"), (4, None)]
    found = assist.answers(spark.createDataFrame(rows, "batch int, text string")).collect()
    assert {tuple(r) for r in found} == {(0, "a", "music"), (1, "c", "x")}


def test_batches_beyond_the_limit_are_planned_but_not_called(spark):
    asked = spark.createDataFrame([(k, f"i{k}", f"t{k // 2}", None) for k in range(10)], "ord long, id string, title string, description string")
    cache = spark.createDataFrame([], "content_hash string, category string")
    plan = assist.batch_plan(asked, cache, Settings(assist_batch_size=2, assist_max_calls=1)).collect()
    assert sorted((r.ord, r.batch, r.called) for r in plan) == [(0, 0, True), (2, 0, True), (4, 1, False), (6, 1, False), (8, 2, False)]
    assert all(re.fullmatch("[0-9a-f]{64}", r.content_hash) for r in plan)


def test_shared_texts_are_shortened_before_they_are_told(spark):
    """Shortened once, a text gives every listing the description that the whole one gives."""
    rng = random.Random(4)
    pieces = ["word", " ", "  \n", "\t", "&amp;", "&lt;b", "x" * 90, " " * 300, " ", "&"]
    rows = ["".join(rng.choices(pieces, k=rng.choice([3, 60, 900]))) for _ in range(150)] + ["", None, " " * 5000, "y" * 5000, " a \n" * 3000]
    frame = spark.createDataFrame([(r, ahead) for r in rows for ahead in ("", "Jazz  koncert ")], "d string, ahead string").withColumn("e", text.shortened("d", 40))
    told = lambda c: text.clean_description(F.concat("ahead", F.col(c)), 40)
    assert all(r.whole == r.short for r in frame.select(told("d").alias("whole"), told("e").alias("short")).collect())
    assert frame.filter("d like ' a %'").select(F.max(F.length("e"))).first()[0] < 200


def test_only_digits_are_cast(spark):
    """A text that a cast refuses costs an error with its message, in every row."""
    texts = ["", "Z", "05", "7", None, "x1"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r.n for r in rows.select(timeparse._num(F.col("v")).alias("n")).collect()] == [0, 0, 5, 7, 0, 0]
    cast = str(timeparse._num(F.col("v")))
    assert "RLIKE" in cast.upper() and cast.upper().index("RLIKE") < cast.upper().index("CAST")
    zips = spark.createDataFrame([("Fo utca 12, 1117 Budapest",), ("utca",), ("12345 1a23 9999",)], "a string")
    assert [r.z for r in zips.select(places.first_zip("a").alias("z")).collect()] == ["1117", None, "9999"]


def test_only_wanted_rows_are_normalized(spark):
    """Scoring reads kept rows and the ledger's; the others lose all but their dates
    before the parsers, and the filter that drops them repeats no date parser."""
    rows = testview.raw(spark, "/root/testdata/sf0.001", 400)
    wanted = F.expr("drop_reason IS NULL OR ord % 11 = 0")
    some, every = (normalize.normalized(rows, testview.SETTINGS, testview.literal_timestamp(), describe_dropped=False, wanted=w) for w in (wanted, None))
    assert sorted(map(str, some.collect())) == sorted(map(str, every.filter(wanted).collect()))
    parsed = some._jdf.queryExecution().optimizedPlan().toString()
    assert parsed.count("convert_timezone") == 2  # start and end
    table = catalog._offered(spark, "/root/testdata/sf0.001")
    assert 0 < table.filter("drop_reason IS NULL").count() < table.count() == every.filter("drop_reason IS NULL OR (ord % 11 = 0 AND id IS NOT NULL)").count()


def test_a_run_counts_all_raw_listings(spark):
    """Also those that neither scoring nor the ledger reads."""
    folder = "/root/testdata/sf0.001"
    rows = testview.raw(spark, folder)
    reasons = normalize.dated(rows, testview.SETTINGS, testview.literal_timestamp()).groupBy("drop_reason").count().collect()
    counts = catalog.QUERIES["fork_views"](spark, folder).first()
    assert counts["raw"] == rows.count() == spark.read.parquet(f"{folder}/events.parquet").count()
    assert counts["dropped_as_past"] == dict(reasons)["dropped_past"] > 0


def test_long_dates_are_taken_apart_once(spark):
    """The words of a long date are split once and its month is usually found as written."""
    texts = ["2024. január 05., szombat 10:30", "2024. JANUÁR  5., szombat 9:05", "2024. December 31., x 23:59", "2024. foo 05., x 10:30", "2024. január 05., szombat 10:3", "2024. január 55., x 10:30"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(timeparse.parse_datetime("t", "Europe/Budapest").alias("x"))
    day = lambda *a: dt.datetime(2024, *a)
    assert [r.x.ts for r in rows.collect()] == [day(1, 5, 10, 30), day(1, 5, 9, 5), day(12, 31, 23, 59), None, None, None]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2


def test_district_words_in_any_case(spark):
    texts = ["XI. kerület", "xi. KERÜLET", "11. Kerület", "XI. ker", "XI. Ker.", "XI. utca", "ix", "XI. kerüLET"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(places.normalize_district("t").alias("d"))
    assert [r.d for r in rows.collect()] == ["XI.", "XI.", "XI.", "XI.", "XI.", None, "IX.", "XI."]
