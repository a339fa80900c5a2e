"""Golden cases of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listweave.config import Settings
from listweave.functions import places, prices, text, timeparse
from listweave.operators import normalize


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("raw", "ts", "known"),
    [
        ("2026-08-15", dt.datetime(2026, 8, 15), False),
        ("2026-08-15T19:30:00+02:00", dt.datetime(2026, 8, 15, 19, 30), True),
        ("20260815T193000Z", dt.datetime(2026, 8, 15, 21, 30), True),
        ("2026. 8. 15. 9:30", dt.datetime(2026, 8, 15, 9, 30), True),
        ("2026.08.15.", dt.datetime(2026, 8, 15), False),
        ("2026. augusztus 15., szombat 19:30", dt.datetime(2026, 8, 15, 19, 30), True),
        ("2026-W33-6T19:30", dt.datetime(2026, 8, 15, 19, 30), True),
        ("2026-08-15 19:30:60", None, None),
        ("2026. 08. 15. 19:30:60", None, None),
        ("2026-08-15T19:30+99:00", None, None),
        ("0000-01-01", None, None),
        ("2026-W336", None, None),
        ("2026-0815T19:30", None, None),
        ("2026-02-30", None, None),
        (None, None, None),
    ],
)
def test_parse_datetime(spark, raw, ts, known):
    assert tuple(one(spark, raw, timeparse.parse_datetime("v", "Europe/Budapest"))) == (ts, known)


@pytest.mark.parametrize(("raw", "folded"), [("Ősz", "osz"), ("𝗖𝗼𝗻𝗰𝗲𝗿𝘁 𝓛𝓲𝓿𝓮", "concert live"), ("ﬁ ½", "fi 1⁄2"), ("한", "\u1112\u1161\u11ab"), ("ABC", "abc"), (None, None)])
def test_fold_text(spark, raw, folded):
    assert one(spark, raw, text.fold_text("v")) == folded


@pytest.mark.parametrize(("raw", "parts"), [("a - - b", ["a", "- b"]), ("a  - b", ["a", "b"]), ("a | b - c", ["a | b", "c"]), ("ab", [None, None])])
def test_separated_tail(spark, raw, parts):
    assert one(spark, raw, F.array(*text.separated_tail("v"))) == parts


@pytest.mark.parametrize(("raw", "district"), [("XI.", "XI."), ("11", "XI."), ("xi. kerület", "XI."), ("1117", "XI."), ("23. ker", "XXIII."), ("24", None), ("1ab", None), (None, None)])
def test_normalize_district(spark, raw, district):
    assert one(spark, raw, places.normalize_district("v")) == district


@pytest.mark.parametrize(("raw", "price"), [("1 200 - 3.500 Ft", (1200, 3500, False)), ("Ingyenes", (0, None, True)), ("?", (None, None, False)), (None, (None, None, False))])
def test_parse_price(spark, raw, price):
    assert tuple(one(spark, raw, prices.parse_price("v"))) == price


@pytest.mark.parametrize(("raw", "word", "hit"), [("koncertek", "koncert", True), ("koncertek", "koncert$", False), ("jazzkoncert", "koncert", False), ("a jazzy", "jazz", False), ("a jazzy", "jazz*", True), ("x", "", False)])
def test_contains_word(spark, raw, word, hit):
    assert one(spark, raw, text.contains_word(F.col("v"), word)) is hit


def test_resolve_year_has_no_leap_day(spark):
    start = F.lit("2028-02-01 10:00:00").cast("timestamp_ntz")
    assert one(spark, "- 02. 29. 10:00", timeparse.resolve_year("v", start)) is None
    assert one(spark, "- 01. 02. 10:00", timeparse.resolve_year("v", start)) == "2029-01-02 10:00:00"


def test_settings_refuse_unknown_keys():
    assert Settings.from_mapping({"schedule": {"horizon_days": 3}}).horizon_days == 3
    for bad in ({"scoringg": {}}, {"scoring": {"free_bonuss": 1}}, {"filters": {"geo": {"town": "x"}}}, {"categories": {"a": {"keyword": {}}}}):
        with pytest.raises(ValueError, match="unknown configuration keys"):
            Settings.from_mapping(bad)


def test_descriptions_by_their_first_words(spark):
    """Cleaning a description by its first words alone gives what the whole text
    gives; texts whose start does not decide go the whole way. Dropped rows are
    only described where asked for."""
    words = lambda n, gap: gap.join(f"szó{k}" for k in range(n))
    odd = [None, "", "  \n ", "x" * 700, "x" * 450 + " " + "y" * 700, words(9, " "), words(300, " "), words(300, "\n"), words(300, "  \t "), words(300, "        "), "a &amp; b " + words(300, " "), words(300, " ") + " &amp;", "  " + words(120, " "), "&" * 900]
    rows = [(k, t, at) for k, t in enumerate(odd) for at in ("2024-01-11", "2023-01-11", None)]
    empty = ("source_id", "title", "venue_name", "url", "native_category", "image_url", "end_raw", "price_raw", "city", "postal_code", "address_raw", "district_raw")
    raw = spark.createDataFrame(rows, "ord long, description string, start_raw string").withColumns({n: F.lit(None).cast("string") for n in empty} | {n: F.lit(None).cast("double") for n in ("lat", "lon")})
    of = lambda every: [(r.ord, r.drop_reason, r.description) for r in normalize.normalized(raw, Settings(), F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz"), describe_dropped=every).collect()]
    plain = {r.k: r.d for r in spark.createDataFrame(list(enumerate(odd)), "k long, t string").select("k", text.clean_description("t", 400).alias("d")).collect()}
    assert of(True) == [(k, reason, plain[k]) for (k, _, _), (_, reason, _) in zip(rows, of(True), strict=True)]
    assert {reason for _, reason, _ in of(True)} == {None, "dropped_past", "unparseable_start"}
    assert of(False) == [(k, reason, plain[k] if reason is None else None) for k, reason, _ in of(True)]
