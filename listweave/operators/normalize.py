"""Raw listings to canonical ones, or to the reason why a row is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.config import DESCRIPTION_LIMIT, Settings
from listweave.functions import places, prices, text, timeparse


def event_id(title_norm: Column, start: Column, venue_norm: Column) -> Column:
    """16 hex digits of title, local day and venue; the clock is not part of it."""
    key = F.concat_ws("|", title_norm, start.cast("date").cast("string"), venue_norm)
    return F.when(start.isNotNull(), F.substring(F.sha2(key, 256), 1, 16))


def is_past(start: Column, known: Column, end: Column, end_known: Column, now: Column) -> Column:
    """The listing's last moment lies behind ``now``; without a clock, its last day does."""
    last, clock = F.coalesce(end, start), F.when(end.isNotNull(), end_known).otherwise(known)
    return F.when(clock, last < now).otherwise(last.cast("date") < now.cast("date"))


def is_beyond(start: Column, known: Column, now: Column, days: int) -> Column:
    far = now + F.expr(f"INTERVAL '{days}' DAY")
    return F.when(known, start > far).otherwise(start.cast("date") > far.cast("date"))


def is_series(start: Column, end: Column, threshold_days: int) -> Column:
    """More whole days from start to end than the threshold; without an end, none."""
    days = F.floor(F.timestamp_diff("SECOND", start, end) / 86400)
    return F.coalesce(days > threshold_days, F.lit(False))


def dated(raw: DataFrame, settings: Settings, now: Column) -> DataFrame:
    """``raw`` with its parsed start and end and ``drop_reason``."""
    parsed = raw.withColumns({"_start": timeparse.parse_datetime("start_raw", settings.timezone), "_end": timeparse.parse_datetime("end_raw", settings.timezone)})
    start, known, end = F.col("_start.ts"), F.col("_start.known"), F.col("_end.ts")
    reason = (
        F.when(start.isNull(), "unparseable_start")
        .when(is_past(start, known, end, F.col("_end.known"), now), "dropped_past")
        .when(is_beyond(start, known, now, settings.horizon_days), "beyond_horizon")
    )
    return parsed.withColumn("drop_reason", reason)


def _only(rows: DataFrame, wanted: Column) -> DataFrame:
    """``rows`` for which ``wanted`` holds. A filter does not move below the
    running id, so the parsers under it are worked out once and not twice."""
    return rows.withColumn("_n", F.monotonically_increasing_id()).filter(wanted & (F.col("_n") >= 0)).drop("_n")


def normalized(raw: DataFrame, settings: Settings, now: Column, describe_dropped: bool = True, wanted: Column | None = None) -> DataFrame:
    """Every raw row with its canonical columns and ``drop_reason``. Nothing is
    shuffled. Filters on the reason belong behind a written table: pushed into
    this projection they would repeat its parsers. A reader that needs some rows
    only names them by ``wanted`` (over raw columns, ``_start``, ``_end`` and the
    reason): all but the dates is worked out for those alone. Descriptions are the
    costliest part; where only kept rows are read, those of dropped ones may be
    left null."""
    parsed = dated(raw, settings, now)
    parsed = (parsed if wanted is None else _only(parsed, wanted)).withColumns({
        "_price": prices.parse_price("price_raw"),
        "title": text.collapse_space("title"),
        "venue_name": text.collapse_space("venue_name"),
    }).withColumns({"title_norm": text.normalize_title("title"), "venue_norm": text.normalize_venue("venue_name")})
    start, known, end = F.col("_start.ts"), F.col("_start.known"), F.col("_end.ts")
    told = F.col("description") if describe_dropped else F.when(F.col("drop_reason").isNull(), F.col("description"))
    parsed = parsed.withColumn("description", told).withColumn("_head", text.first_words("description", DESCRIPTION_LIMIT))
    parsed = parsed.withColumn("description", text.enough_of(F.when(F.col("_head").isNull(), F.col("description")), DESCRIPTION_LIMIT))
    description = F.coalesce(text.cut_at_space(F.col("_head"), DESCRIPTION_LIMIT), text.clean_description("description", DESCRIPTION_LIMIT))
    return parsed.select(
        "ord", "source_id", "title", "title_norm", "venue_norm", description.alias("description"),
        "url", "venue_name", "native_category", "image_url",
        start.alias("start"), end.alias("end"), "lat", "lon", known.alias("start_time_known"),
        timeparse.effective_date(start, known, settings.night_shift_hours).alias("effective_date"),
        is_series(start, end, settings.series_threshold_days).alias("is_series"),
        event_id(F.col("title_norm"), start, F.col("venue_norm")).alias("id"),
        text.normalize_url("url").alias("url_norm"),
        places.derive_city("city", "postal_code", "address_raw").alias("city"),
        places.district("district_raw", "postal_code").alias("district"),
        places.distance_km(settings.home, F.col("lat"), F.col("lon")).alias("distance_km"),
        F.col("_price.price_min").alias("price_min"), F.col("_price.price_max").alias("price_max"), F.col("_price.is_free").alias("is_free"),
        "drop_reason",
    )


def kept(rows: DataFrame) -> DataFrame:
    return rows.filter("drop_reason IS NULL").drop("drop_reason")
