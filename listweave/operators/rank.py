"""Categories, content filter and score, each one projection without a shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listweave.config import NATIVE_TYPE_POINTS, PINNED_BONUS, SCORE_TERMS, URL_PATTERN_POINTS, VENUE_MATCH_RATIO, WEEKDAYS, Settings
from listweave.functions import similarity, text


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def with_text(listings: DataFrame) -> DataFrame:
    """Title and description folded once, for all keyword rules."""
    return listings.withColumn("haystack", text.listing_text())


def venue_matches(venue: Column, other: Column) -> Column:
    a, b = text.venue_tokens(venue), text.venue_tokens(other)
    return F.coalesce((a != "") & (b != "") & (similarity.token_set_ratio(a, b) >= VENUE_MATCH_RATIO), F.lit(False))


def venue_rules(spark: SparkSession, settings: Settings) -> DataFrame:
    """(category, place, rule, weight) of the configured venue rules, as a table."""
    rows = [(c, k, name, float(w)) for c, rules in settings.categories.items() for k, (name, w) in enumerate(rules.venue_prior.items())]
    return spark.createDataFrame(rows, "category string, place int, rule string, weight double")


def venue_priors(listings: DataFrame, rules: DataFrame) -> DataFrame:
    """(venue_name, category, rule, weight): for each distinct venue the first rule
    of each category that names it. Distinct venues meet the rules, not listings."""
    tokens = lambda rows, c: rows.select(c, text.venue_tokens(c).alias("text")).distinct()
    venues, named = tokens(listings.filter("venue_name IS NOT NULL"), "venue_name"), tokens(rules, "rule")
    alike = similarity.similar(venues.select("text"), named.select("text"), VENUE_MATCH_RATIO)
    pairs = venues.join(alike.select(F.col("a").alias("text"), "b"), "text").drop("text").join(named.withColumnRenamed("text", "b"), "b").drop("b")
    first = pairs.join(rules, "rule").groupBy("venue_name", "category").agg(F.min_by(F.struct("rule", "weight"), "place").alias("r"))
    return first.select("venue_name", "category", "r.rule", "r.weight")


def unmatched_rules(listings: DataFrame, rules: DataFrame) -> DataFrame:
    """Venue rules that name no venue of the whole corpus."""
    tokens = lambda rows, c: rows.select(text.venue_tokens(c).alias("text")).distinct()
    matched = similarity.similar(tokens(rules, "rule"), tokens(listings.filter("venue_name IS NOT NULL"), "venue_name"), VENUE_MATCH_RATIO).select("a").distinct()
    return rules.withColumn("a", text.venue_tokens("rule")).join(matched, "a", "left_anti").select("category", "rule")


def signals(name: str, settings: Settings) -> list[tuple[str, Column]]:
    """(signal, points) of one category: its keywords, the first venue rule that
    matches, URL patterns and native types."""
    rules = settings.categories[name]
    points = lambda c, w: F.when(c, F.lit(float(w))).otherwise(0.0)
    out = [(f"keyword:{k}", points(text.contains_word(F.col("haystack"), k), w)) for k, w in rules.keywords.items()]
    if rules.venue_prior:
        out.append(("venue_prior", F.coalesce(F.try_element_at("priors", F.lit(name)), F.lit(0.0))))
    if rules.url_patterns:
        out.append(("url_pattern", points(reduce(lambda a, b: a | b, [F.col("url").contains(p) for p in rules.url_patterns]), URL_PATTERN_POINTS)))
    if rules.native_types:
        out.append(("native_type", points(F.coalesce(F.col("native_category").isin(list(rules.native_types)), F.lit(False)), NATIVE_TYPE_POINTS)))
    return out


def with_priors(listings: DataFrame, settings: Settings) -> DataFrame:
    """``listings`` with ``priors``, the venue's points by category."""
    found = venue_priors(listings, venue_rules(listings.sparkSession, settings))
    by_venue = found.groupBy("venue_name").agg(F.map_from_entries(F.collect_list(F.struct("category", "weight"))).alias("priors"))
    return listings.join(by_venue, "venue_name", "left")


def explained(listings: DataFrame, settings: Settings) -> DataFrame:
    """``listings`` with ``category_scores``: (total, place, name, signals) of each
    category; of the signals only those that count."""
    scores = []
    for k, name in enumerate(settings.categories):
        parts = signals(name, settings)
        shown = F.filter(F.array(*[F.struct(F.lit(n).alias("signal"), c.alias("weight")) for n, c in parts]), lambda x: x["weight"] != 0)
        scores.append(F.struct(_sum([c for _, c in parts]).alias("total"), F.lit(k).alias("place"), F.lit(name).alias("name"), shown.alias("signals")))
    return with_priors(listings, settings).withColumn("category_scores", F.array(*scores)).drop("priors")


def categorized(listings: DataFrame, settings: Settings) -> DataFrame:
    """``categories`` by points, ties in configured order; the fallback if none qualifies."""
    qualifying = F.filter("category_scores", lambda x: x["total"] >= settings.min_category_score)
    by_points = F.array_sort(F.transform(qualifying, lambda x: F.struct((-x["total"]).alias("t"), x["place"].alias("p"), x["name"].alias("n"))))
    names = F.transform(by_points, lambda x: x["n"])
    scored = explained(listings, settings)
    return scored.withColumn("categories", F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(settings.fallback_category)))).drop("category_scores")


def exclusion(settings: Settings, hidden: Column) -> Column:
    """The first reason to leave a listing out; null keeps it."""
    f = settings.filters
    reason = F.when(hidden, "hidden_by_override")
    if f.city is not None:
        if not f.allow_missing_city:
            reason = reason.when(F.col("city").isNull(), "geo_city_missing")
        reason = reason.when(F.trim(text.fold_text("city")) != F.trim(text.fold_text(F.lit(f.city))), "geo_city_mismatch")
    if f.max_distance_km is not None:
        reason = reason.when(F.col("distance_km") > f.max_distance_km, "geo_too_far")
    if f.categories is not None:
        reason = reason.when(~F.arrays_overlap("categories", F.array(*map(F.lit, f.categories))), "category_not_allowed")
    if f.max_price is not None:
        reason = reason.when(F.col("price_min") > f.max_price, "price_too_high")
    for word in f.blocked_keywords:
        reason = reason.when(text.contains_word(F.col("haystack"), word, prefix_by_default=False), "blocked_keyword")
    return reason


def score_terms(settings: Settings, now: Column, sent: Column, pinned: Column) -> dict[str, Column]:
    s = settings.scoring
    zero = F.lit(0.0)
    weights = F.create_map(*[F.lit(x) for k, w in settings.category_weights.items() for x in (k, float(w))])
    points = lambda c, n: F.when(F.coalesce(c, F.lit(False)), F.lit(float(n))).otherwise(zero)
    days = F.array(*[F.lit(float(s.weekday_weights.get(d, 0.0))) for d in WEEKDAYS])
    far = F.col("distance_km") if s.penalty_cap_km is None else F.least("distance_km", F.lit(float(s.penalty_cap_km)))
    near = s.distance_penalty_per_km is not None
    soon = F.col("start").between(now, now + F.expr(f"INTERVAL '{s.soon_within_days or 0}' DAY"))
    terms = {
        "category_weight": F.coalesce(F.try_element_at(weights, F.get("categories", F.lit(0))), zero),
        "keyword_boosts": _sum([points(text.contains_word(F.col("haystack"), k), w) for k, w in s.keyword_boosts.items()]),
        "free_bonus": points(F.col("is_free"), s.free_bonus),
        "cheap_bonus": points(F.col("price_min") < s.cheap_under, s.cheap_points) if s.cheap_under is not None else zero,
        "same_district_bonus": points(F.col("district") == settings.home.district, s.same_district_bonus) if near and settings.home else zero,
        "distance_penalty": F.coalesce(-(far * s.distance_penalty_per_km), zero) if near else zero,
        "novelty_bonus": points(~sent, s.novelty_bonus),
        "soon_bonus": points(soon, s.soon_points) if s.soon_within_days is not None else zero,
        "weekday_weight": F.coalesce(F.get(days, F.weekday("effective_date")), zero),
        "pinned_bonus": points(pinned, PINNED_BONUS),
    }
    return {name: terms[name] for name in SCORE_TERMS}


def scored(listings: DataFrame, settings: Settings, now: Column, sent: Column, pinned: Column) -> DataFrame:
    """``listings`` with every term and ``score``, the sum in their fixed order."""
    terms = score_terms(settings, now, sent, pinned)
    return listings.withColumns(terms).withColumn("score", _sum([F.col(n) for n in terms]))


def flagged(listings: DataFrame, **ids: DataFrame) -> DataFrame:
    """``listings`` with a flag for each table of ids: is the row's id in it?"""
    for name, table in ids.items():
        listings = listings.join(table.select("id").distinct().withColumn(name, F.lit(True)), "id", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return listings


def keyword_matches(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, keyword): which keywords of a table (keyword) the folded texts (key,
    haystack) hold. A keyword's first run of letters and digits must stand in a
    text as a word, or as the start of one if the keyword is a prefix, so texts
    and rules meet on it by equality and only such pairs are verified: the plan
    does not grow with the rules."""
    word, whole = text.keyword_rule(F.col("keyword"))
    table = rules.select("keyword", word.alias("word"), whole.alias("whole")).filter("word <> ''").distinct()
    first = F.coalesce(F.get(F.filter(F.split("word", r"(?U)\W+"), lambda w: w != ""), F.lit(0)), F.lit(""))
    start = ~F.col("whole") & F.rlike("word", F.lit(r"(?U)^\W*\w+$"))
    indexed = table.withColumn("meet", F.concat(F.when(start, "p").otherwise("t"), first))
    tokens = F.array_distinct(F.split("haystack", r"(?U)\W+"))
    parts = F.flatten(F.transform(F.filter(tokens, lambda w: w != ""), lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda n: F.concat(F.lit("p"), F.left(w, n)))))
    keys = F.array_distinct(F.concat(F.transform(tokens, lambda w: F.concat(F.lit("t"), w)), parts, F.array(F.lit("t"))))
    met = texts.select("key", "haystack", F.explode(keys).alias("meet")).join(indexed, "meet")
    return met.filter(text.holds_word(F.col("haystack"), F.col("word"), F.col("whole"))).select("key", "keyword").distinct()
