"""Group collapse, limits, sections, facets and counters over scored listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.config import GROUP_DESCRIPTION_TITLES, Settings
from listweave.functions import text
from listweave.operators import display

GROUP = ("venue_name", "effective_date", "category")


def with_primary(listings: DataFrame) -> DataFrame:
    return listings.withColumn("category", F.get("categories", F.lit(0)))


def _by_score() -> list[Column]:
    return [F.desc("score"), F.asc("ord")]


def _first_seen(named: str) -> Column:
    """Names of (first, name) in the order of their first places; absent ones are left out."""
    there = F.filter(named, lambda x: x["first"].isNotNull())
    return F.transform(F.array_sort(there), lambda x: x["name"])


def grouped(listings: DataFrame, settings: Settings) -> DataFrame:
    """Crowded (venue, day, category) slots collapse into one row, others keep
    their best rows up to the cap; listings without a venue pass. The rank and
    size of a slot decide, so a slot's rows are never collected."""
    slot = Window.partitionBy(*GROUP)
    ranked = with_primary(listings).filter("venue_name IS NOT NULL").withColumn("size", F.count("*").over(slot)).withColumn("rank", F.row_number().over(slot.orderBy(*_by_score())))
    crowded = F.col("size") >= settings.min_group_size
    tops = F.sort_array(F.collect_list(F.when(F.col("rank") <= GROUP_DESCRIPTION_TITLES, F.struct("rank", "title"))))  # at most so many titles
    one = ranked.filter(crowded).groupBy(*GROUP).agg(
        F.count("*").alias("group_size"), F.max("score").alias("score"), F.min("start").alias("start"), F.min("ord").alias("ord"),
        F.max_by(F.struct("start_time_known", "district", "price_min", "is_free", "pinned_bonus"), -F.col("rank")).alias("top"),
        F.array(*[F.struct(F.min(F.when(F.array_contains("categories", c), F.struct("ord", F.array_position("categories", c).alias("at")))).alias("first"), F.lit(c).alias("name")) for c in settings.category_order]).alias("named"),
        F.array_join(F.transform(tops, lambda x: x["title"]), ", ").alias("description"), F.min_by("url", "rank").alias("url"),
    )
    one = one.withColumn("title", F.concat("venue_name", F.lit(" — "), F.col("group_size").cast("string"), F.lit(" program")))
    key = F.concat_ws("|", F.lit("group"), text.normalize_venue("venue_name"), F.col("effective_date").cast("string"), "category")
    one = one.select("*", "top.*", F.substring(F.sha2(key, 256), 1, 16).alias("id"), _first_seen("named").alias("categories"))
    columns = ["ord", "id", "title", "venue_name", "effective_date", "category", "categories", "start", "start_time_known", "district", "price_min", "is_free", "score", "pinned_bonus", "url", "description", "group_size"]
    single = ranked.filter(~crowded & (F.col("rank") <= settings.max_per_venue)).withColumn("group_size", F.lit(1).cast("long"))
    free = with_primary(listings).filter("venue_name IS NULL").withColumn("group_size", F.lit(1).cast("long"))
    return one.select(*columns).union(single.select(*columns)).union(free.select(*columns))


def limited(rows: DataFrame, settings: Settings) -> DataFrame:
    """The delta view: best rows of each category, then the best of those up to
    the total. Of equal scores those go first that stand first by category, in
    the order in which categories first occur, and rank. Only already limited
    rows meet in one place."""
    category = Window.partitionBy("category")
    ranked = rows.withColumns({"rank": F.row_number().over(category.orderBy(*_by_score())), "bucket": F.min("ord").over(category)})
    best = ranked.filter(F.col("rank") <= settings.per_category_limit)
    return best.orderBy(F.desc("score"), F.desc("bucket"), F.desc("rank")).limit(settings.total_limit)


def published(rows: DataFrame) -> DataFrame:
    """The full view's public columns, best first; of the score what a pin added is
    taken off again, and nothing of its terms is told."""
    ordered = rows.orderBy(F.desc("score"), F.asc("start"), F.asc("ord"))
    return ordered.select(
        "id", "title", "url", "start", "start_time_known", "effective_date", F.col("venue_name").alias("venue"), "district", "categories", "price_min", "is_free",
        (F.col("score") - F.col("pinned_bonus")).alias("score"), "group_size",
    )


def sectioned(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` with the place of their section: configured order, other
    categories by name after it, the fallback last."""
    order = [c for c in settings.category_order if c != settings.fallback_category]
    place = F.array_position(F.array(*map(F.lit, order)), F.col("category"))
    return rows.withColumn("section", F.when(F.col("category") == settings.fallback_category, len(order) + 2).when(place == 0, len(order) + 1).otherwise(place))


def expiring(rows: DataFrame, settings: Settings, today: Column) -> DataFrame:
    left = F.date_diff("effective_date", today)
    return rows.filter((F.col("group_size") == 1) & left.between(0, settings.expiring_within_days)).withColumn("days_left", left)


def filters(categories=None, since=None, until=None, free=False, max_price=None, district=None) -> dict[str, Column]:
    """The conditions of the interactive view, by name; absent ones are left out."""
    out = {}
    if categories:
        out["categories"] = F.arrays_overlap("categories", F.array(*map(F.lit, categories)))
    if since:
        out["dates"] = F.col("effective_date").between(F.lit(since).cast("date"), F.lit(until or since).cast("date"))
    if free:
        out["free"] = F.col("is_free") | F.coalesce(F.col("price_min") == 0, F.lit(False))
    if max_price is not None:
        out["price"] = F.col("is_free") | F.coalesce(F.col("price_min") <= max_price, F.lit(True))
    if district:
        out["district"] = F.coalesce(F.col("district") == district, F.lit(False))
    return out


def date_range(name: str, today: Column, day: str = "effective_date") -> Column:
    """The named ranges of the interactive view: all, today, tomorrow, the next
    seven days (both ends count), and Fridays to Sundays among those."""
    away = F.date_diff(F.col(day), today)
    week = away.between(0, 7)
    named = {"all": F.lit(True), "today": away == 0, "tomorrow": away == 1, "week": week, "weekend": week & (F.weekday(day) >= 4)}
    return F.coalesce(named[name], F.lit(False))


def searched(rows: DataFrame, query: str) -> DataFrame:
    """Rows whose title, venue or category names hold the query, accents and case aside."""
    names = F.array_join(F.transform("categories", display.category_label), " ")
    return rows.filter(text.fold_text(F.concat_ws(" ", "title", "venue_name", names)).contains(text.fold_text(F.lit(query.strip()))))


def applied(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return rows.filter(reduce(lambda a, b: a & b, conditions.values(), F.lit(True)))


def relaxed(rows: DataFrame, conditions: dict[str, Column], most: int = 3) -> DataFrame:
    """For each condition, how many rows the others alone would show, counted in
    one pass; the ``most`` that show most, none that shows nothing."""
    without = {n: reduce(lambda a, b: a & b, [c for m, c in conditions.items() if m != n], F.lit(True)) for n in conditions}
    counts = rows.agg(*[F.count_if(c).alias(n) for n, c in without.items()])
    options = F.array(*[F.struct((-F.col(n)).alias("less"), F.lit(k).alias("place"), F.lit(n).alias("without"), F.col(n).alias("n")) for k, n in enumerate(without)])
    best = F.slice(F.array_sort(F.filter(options, lambda x: x["n"] > 0)), 1, most)
    return counts.select(F.explode(best).alias("r")).select("r.without", "r.n")


def day_counts(rows: DataFrame) -> DataFrame:
    """Rows per day, for the headers between days."""
    return rows.groupBy("effective_date").agg(F.count("*").alias("n"))
