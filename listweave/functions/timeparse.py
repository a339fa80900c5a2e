"""Start/end text to local wall-clock time.

Each accepted form is rewritten to one delimited text, split once and built with
try_make_timestamp_ntz, so an impossible date is null rather than an error. The
clock bit comes from the form that matched, never from the value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listweave.functions.text import _col, bound, strip_space, words_array

# Month names of the long display form, January first.
MONTHS = (
    "január",
    "február",
    "március",
    "április",
    "május",
    "június",
    "július",
    "augusztus",
    "szeptember",
    "október",
    "november",
    "december",
)

# Each form is rewritten to "year|month|day|hour|minute|second|fraction|offset"
# by one replacement; a week form puts "W<week>" and the weekday for month and day.
_DAY = {"extended": r"(\d{4})-(\d{2})-(\d{2})", "basic": r"(\d{4})(\d{2})(\d{2})"}
_WEEK = {"extended": r"(\d{4})-(W\d{2})(?:-([1-7]))?", "basic": r"(\d{4})(W\d{2})([1-7])?"}
_CLOCK = {
    "extended": r"(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9})\d*)?)?)?",
    "basic": r"(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,9})\d*)?)?",
}
_OFFSET = r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?"
_DOTTED = (r"(\d{4})\.\s+(\d{1,2})\.\s+(\d{1,2})\.", r"(\d{4})\.(\d{1,2})\.(\d{1,2})\.")
_HOURS = r"\s+(\d{1,2}):(\d{1,2})"

def _iso(day: str) -> tuple:
    return ((f"^{day}$", "$1|$2|$3|||||", False), *((f"(?s)^{day}.{clock}{_OFFSET}$", "$1|$2|$3|$4|$5|$6|$7|$8", True) for clock in _CLOCK.values()))


#: By the characters after the year: (pattern, rewritten, clock known?), tried in order.
_FORMS = {
    "-W": _iso(_WEEK["extended"]),
    "-": _iso(_DAY["extended"]),
    "W": _iso(_WEEK["basic"]),
    ".": (
        *((f"(?U)^{day}$", "$1|$2|$3|||||", False) for day in _DOTTED),
        *((f"(?U)^{day}{_HOURS}$", "$1|$2|$3|$4|$5|||", True) for day in _DOTTED),
        (f"(?U)^{_DOTTED[0]}{_HOURS}:(\\d{{1,2}})$", "$1|$2|$3|$4|$5|$6||", True),
    ),
    "": _iso(_DAY["basic"]),
}


def _num(c: Column) -> Column:
    """'' or null reads as 0. Only digits are cast: each text that a cast refuses
    costs an error with its message, more than all the rest of the row."""
    return F.coalesce(F.when(c.rlike("^[0-9]+$"), c.try_cast("int")), F.lit(0))


def _long_form(c: Column) -> Column:
    """`2026. augusztus 15., szombat 19:30` rewritten like the other forms: the
    text's shape is compared first, then its words are taken apart."""
    shape = lambda s: F.regexp_replace(F.regexp_replace(s, r"(?U)\d+", "9"), r"(?U)[\w&&[^9]]+", "w")
    spaced = F.regexp_replace(c, r"(?U)\s+", " ")
    return bound(spaced, lambda s: F.when(shape(s) == "9. w 9., w 9:9", bound(F.split(s, r"[ .,:]+"), _long_parts)))


def _month(word: Column) -> Column:
    """The place of a month's name, 0 if it is none; lower() is slow on names with accents."""
    place = lambda w: F.array_position(words_array(MONTHS), w)
    return bound(place(word), lambda k: F.when(k > 0, k).otherwise(place(F.lower(word))))


def _long_parts(parts: Column) -> Column:
    at = lambda k: F.get(parts, F.lit(k))
    sized = (F.length(at(0)) == 4) & (F.length(at(2)) <= 2) & (F.length(at(4)) <= 2) & (F.length(at(5)) == 2)
    return bound(_month(at(1)), lambda month: F.when(sized & (month > 0), F.concat_ws("|", at(0), month.cast("string"), at(2), at(4), at(5), F.lit("||"))))


def _rewritten(c: Column) -> Column:
    """The parts of the first form that fits, delimited. The characters after the
    year decide which forms are compared at all."""
    out = F.when(F.lit(False), c)
    for follows, forms in _FORMS.items():
        fits = F.when(F.lit(False), c)
        for pattern, target, known in forms:
            fits = fits.when(c.rlike(pattern), F.concat(F.regexp_replace(c, pattern, target), F.lit(f"|{int(known)}")))
        if follows == ".":
            fits = fits.otherwise(F.concat(_long_form(c), F.lit("|1")))
        out = out.when(F.substring(c, 5, len(follows)) == follows, fits)
    return out


def parse_datetime(value: Column | str, timezone: str) -> Column:
    """STRUCT<ts TIMESTAMP_NTZ, known BOOLEAN>; ts is null when nothing fits.
    Seconds of 60, offsets of a day or more and the year 0 do not fit.

    Each step works on the one element of an array, so that what it builds on
    is computed once, wherever the optimizer moves or copies references."""
    parts = F.transform(F.array(strip_space(value)), lambda c: F.split(_rewritten(c), "\\|"))
    naive = F.transform(parts, lambda p: F.struct(p.alias("p"), _naive(p).alias("ts")))
    return F.get(F.transform(naive, lambda n: _localized(n["p"], n["ts"], timezone)), F.lit(0))


def _naive(p: Column) -> Column:
    """Wall-clock time of the parts; the cast refuses what no calendar or clock has."""
    at = lambda k: F.coalesce(F.nullif(F.get(p, F.lit(k)), F.lit("")), F.lit("0"))
    clock = F.concat(F.lit(" "), at(3), F.lit(":"), at(4), F.lit(":"), at(5), F.lit("."), F.substring(at(6), 1, 6))
    day = F.concat(at(0), F.lit("-"), at(1), F.lit("-"), at(2))
    by_day = F.when(at(0) != "0000", F.concat(day, clock).try_cast("timestamp_ntz"))
    by_week = F.concat(_week_day(_num(at(0)), _num(F.substring(at(1), 2, 2)), F.greatest(_num(at(2)), F.lit(1))).cast("string"), clock).try_cast("timestamp_ntz")
    return F.when(at(1).startswith("W"), by_week).otherwise(by_day)


def _week_day(year: Column, week: Column, weekday: Column) -> Column:
    """The date of an ISO week and weekday; null if the year has no such week."""
    fourth = F.try_make_timestamp_ntz(year, F.lit(1), F.lit(4), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), ((week - 1) * 7).cast("int"))
    return F.when((week >= 1) & (F.weekofyear(monday) == week), F.date_add(monday, weekday - 1))


def _localized(p: Column, naive: Column, timezone: str) -> Column:
    known = F.get(p, F.lit(8)) == "1"
    shown = lambda ts: F.struct(ts.alias("ts"), F.when(ts.isNotNull(), known).alias("known"))
    zoned = bound(F.regexp_replace(F.get(p, F.lit(7)), "[:+-]", ""), lambda digits: _zoned(p, naive, digits, timezone))
    return F.when(F.get(p, F.lit(7)) == "", shown(naive)).otherwise(bound(zoned, shown))


def _zoned(p: Column, naive: Column, digits: Column, timezone: str) -> Column:
    """Local time of a clock with an offset (its digits); null if that is a day or more."""
    numbers = F.struct(*[_num(F.substring(digits, k, 2)).alias(n) for n, k in (("h", 1), ("m", 3), ("s", 5))])

    def local(o: Column) -> Column:
        signed = (o["h"] * 3600 + o["m"] * 60 + o["s"]) * F.when(F.get(p, F.lit(7)).startswith("-"), F.lit(-1)).otherwise(F.lit(1))
        utc = naive - F.make_dt_interval(secs=signed.cast("decimal(18,6)"))
        return F.when((o["h"] <= 23) & (o["m"] <= 59) & (o["s"] <= 59), F.convert_timezone(F.lit("UTC"), F.lit(timezone), utc))

    return bound(numbers, local)


def effective_date(start: Column, known: Column, shift_hours: int) -> Column:
    """Early-morning starts belong to the previous evening, but only when the
    clock is real."""
    shifted = start - F.expr(f"INTERVAL '{shift_hours}' HOUR")
    return F.when(known, shifted.cast("date")).otherwise(start.cast("date"))


def _shape(text: Column) -> Column:
    """Digits as 9, everything else as it is."""
    return F.translate(text, "012345678", "999999999")


def combine_start(event_date: Column | str, event_time: Column | str) -> Column:
    """A date marker plus `H:MM`; null when either half is unusable."""
    marker, clock = F.split(_col(event_date), "T"), F.split(strip_space(event_time), ":")
    day, hour, minute = F.get(marker, F.lit(0)), F.get(clock, F.lit(0)), F.get(clock, F.lit(1))
    shaped = (F.size(marker) > 1) & (_shape(day) == "9999-99-99") & (F.size(clock) == 2) & _shape(hour).isin("9", "99") & (_shape(minute) == "99")
    good = F.coalesce(shaped & (_num(hour) <= 23) & (_num(minute) <= 59), F.lit(False))
    return F.when(good, F.concat(day, F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":"), minute, F.lit(":00")))


def resolve_year(end_text: Column | str, start: Column) -> Column:
    """`- MM. DD. HH:MM` takes the start's year, or the next one when that would
    end before it starts. A day without a year is never 29 February."""
    text = strip_space(F.regexp_replace(strip_space(end_text), "^-+", ""))
    form = r"(?U)^(\d{1,2})\.\s+(\d{1,2})\.\s+(\d{1,2}):(\d{1,2})$"
    mo, d, h, mi = (_num(F.regexp_extract(text, form, i)) for i in (1, 2, 3, 4))
    at = lambda year: F.try_make_timestamp_ntz(year, mo, d, h, mi, F.lit(0))
    same, after = at(F.year(start)), at(F.year(start) + 1)
    readable = text.rlike(form) & ~((mo == 2) & (d == 29))
    end = F.when(readable, F.when(same < start, after).otherwise(same))
    return F.date_format(end, "yyyy-MM-dd HH:mm:ss")


def placeholder_clock(start_text: Column | str, prose: Column | str) -> tuple[Column, Column]:
    """(start text, reject reason) for sources that print midnight when they do
    not know the clock: a prose date beside it proves the placeholder, so only
    the date is kept; without one the record is rejected."""
    c = strip_space(start_text)
    midnight = c.rlike("T00:00:00")
    has_prose = F.coalesce(strip_space(prose), F.lit("")) != ""
    kept = F.when(~midnight, c).when(has_prose, F.substring_index(c, "T", 1))
    return kept, F.when(midnight & ~has_prose, F.lit("placeholder_start"))
