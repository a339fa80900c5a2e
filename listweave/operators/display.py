"""Texts that a reader sees beside a listing, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.functions.timeparse import MONTHS

# Display names of the categories, weekdays (Monday first) and their dative.
CATEGORY_LABELS = {
    "koncert": "Koncert",
    "klub": "Klub",
    "szinhaz": "Színház",
    "kiallitas": "Kiállítás",
    "film": "Film",
    "meetup": "Meetup",
    "tarsasjatek": "Társasjáték",
    "kviz": "Kvíz",
    "gasztro": "Gasztro",
    "fesztival": "Fesztivál",
    "outdoor": "Outdoor",
    "sport": "Sport",
    "csaladi": "Családi",
    "egyeb": "Egyéb",
}
WEEKDAYS = ("hétfő", "kedd", "szerda", "csütörtök", "péntek", "szombat", "vasárnap")
WEEKDAYS_DATIVE = ("hétfőre", "keddre", "szerdára", "csütörtökre", "péntekre", "szombatra", "vasárnapra")
#: A score bar has so many segments, each worth so many points.
BAR_SEGMENTS, BAR_STEP = 7, 2


def _pick(names: tuple[str, ...], place: Column) -> Column:
    return F.get(F.array(*map(F.lit, names)), place)


def category_label(slug: Column) -> Column:
    """The display name; a slug without one stands for itself."""
    labels = F.create_map(*[F.lit(x) for pair in CATEGORY_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, slug), slug)


def unlabelled(rows: DataFrame) -> DataFrame:
    """(category, n): categories without a display name and the rows that show them."""
    slugs = rows.select(F.explode("categories").alias("category"))
    return slugs.filter(~F.col("category").isin(*CATEGORY_LABELS)).groupBy("category").agg(F.count("*").alias("n"))


def month_day(day: Column) -> Column:
    return F.concat(_pick(MONTHS, F.month(day) - 1), F.lit(" "), F.dayofmonth(day).cast("string"), F.lit("."))


def full_date(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit(". "), month_day(day))


def time_label(start: Column, known: Column) -> Column:
    """The clock; empty where the source told none."""
    return F.when(known, F.date_format(start, "HH:mm")).otherwise("")


def when_label(day: Column, today: Column, time: Column | None = None) -> Column:
    """Weekday (today and tomorrow by their words), date and, where known, clock."""
    away = F.date_diff(day, today)
    name = F.when(away == 0, "ma").when(away == 1, "holnap").otherwise(_pick(WEEKDAYS, F.weekday(day)))
    label = F.concat(name, F.lit(", "), month_day(day))
    return label if time is None else F.when(time != "", F.concat(label, F.lit(", "), time)).otherwise(label)


def night_note(start: Column, day: Column) -> Column:
    """Which night a listing of the small hours is on; null where the calendar day is the evening's."""
    return F.when(start.cast("date") != day, F.concat(F.lit("éjjel, "), _pick(WEEKDAYS_DATIVE, F.weekday(start.cast("date")))))


def price_label(free: Column, price: Column) -> Column:
    grouped = F.replace(F.format_number(price, 0), F.lit(","), F.lit(" "))
    return F.when(free, "ingyenes").when(price.isNotNull(), F.concat(grouped, F.lit(" Ft"))).otherwise("ár nincs megadva")


def score_bar(score: Column) -> Column:
    """Lit segments of the score bar."""
    return F.least(F.lit(BAR_SEGMENTS), F.greatest(F.lit(0), F.ceil(score / BAR_STEP))).cast("int")


def meta_text(venue: Column, district: Column, price: Column) -> Column:
    """Venue, district and price; absent and empty parts are left out."""
    some = lambda c: F.when(c != "", c)
    return F.concat_ws(" · ", some(venue), F.concat(some(district), F.lit(" kerület")), price)


def group_label(size: Column, day: Column, today: Column) -> Column:
    return F.concat(F.lit("Egy helyszín, több program · "), size.cast("string"), F.lit(" program · "), when_label(day, today))


def labelled(rows: DataFrame, today: Column) -> DataFrame:
    """``rows`` of the view with the texts of their line."""
    c = F.col
    return rows.withColumns({
        "when_label": F.when(c("group_size") > 1, group_label(c("group_size"), c("effective_date"), today)).otherwise(when_label(c("effective_date"), today, time_label(c("start"), c("start_time_known")))),
        "full_date": full_date(c("effective_date")),
        "category_labels": F.array_join(F.transform("categories", category_label), ", "),
        "score_bar": score_bar(c("score")),
        "night_note": night_note(c("start"), c("effective_date")),
        "meta_text": meta_text(c("venue_name"), c("district"), price_label(c("is_free"), c("price_min"))),
    })


def subject(rows: DataFrame, today: Column) -> DataFrame:
    """One row: the subject line of a run that shows ``rows``."""
    counted = rows.agg(F.count("*").alias("n"))
    told = F.when(F.col("n") == 0, "ma nincs semmi").otherwise(F.concat(F.col("n").cast("string"), F.lit(" új program")))
    return counted.select(F.concat(F.lit("Budapest — "), full_date(today), F.lit(": "), told).alias("subject"))
