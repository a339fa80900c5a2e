"""Tables around a model that names categories: what to ask, in which batches, and
what to make of its answers. The call itself is not part of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.config import ASSIST_MIN_DESCRIPTION, Settings
from listweave.operators.sources import numbered


def content_hash() -> Column:
    """The question asked about a listing: equal texts are one question."""
    return F.sha2(F.concat("title", F.lit("\n"), F.coalesce("description", F.lit(""))), 256)


def eligible(listings: DataFrame, settings: Settings) -> DataFrame:
    """Listings that no rule recognised and that say enough to ask about."""
    alone = F.col("categories") == F.array(F.lit(settings.fallback_category))
    return listings.filter(alone & (F.length("description") > ASSIST_MIN_DESCRIPTION))


def batch_plan(asked: DataFrame, cache: DataFrame, settings: Settings) -> DataFrame:
    """(content_hash, id, ord, batch, called): the first listing of each question
    that the cache (content_hash, category) does not answer, numbered through in
    input order; batches beyond the limit are planned, too, but not called."""
    first = asked.groupBy(content_hash().alias("content_hash")).agg(F.min_by("id", "ord").alias("id"), F.min("ord").alias("ord"))
    placed = numbered(first.join(cache, "content_hash", "left_anti"), ["ord"], name="place")
    batch = F.floor((F.col("place") - 1) / settings.assist_batch_size)
    limit = settings.assist_max_calls
    return placed.select("content_hash", "id", "ord", batch.alias("batch"), (F.lit(True) if limit is None else batch < limit).alias("called"))


def answers(responses: DataFrame) -> DataFrame:
    """(batch, id, category) of response texts (batch, text): fences around the
    object are taken off, values that are no text are left out, and what is no
    object gives no row."""
    inner = F.trim(F.regexp_replace(F.trim("text"), r"(?s)^```[^\n]*\n|```$", ""))
    pairs = responses.select("batch", F.explode(F.from_json(inner, "map<string,variant>")).alias("id", "value"))
    return pairs.filter(F.schema_of_variant("value") == "STRING").select("batch", "id", F.try_variant_get("value", "$", "string").alias("category"))


def named(plan: DataFrame, found: DataFrame, settings: Settings) -> DataFrame:
    """(content_hash, category) of the called questions whose answer is a category."""
    known = found.filter(F.col("category").isin(list(settings.categories)))
    return plan.filter("called").join(known, ["batch", "id"]).select("content_hash", "category")


def applied(listings: DataFrame, asked: DataFrame, cache: DataFrame) -> DataFrame:
    """``listings`` with the category of their question where it was asked and the
    cache has it; every row stays, the others with what the rules said."""
    mine = asked.select("ord", content_hash().alias("content_hash")).join(cache, "content_hash").select("ord", "category")
    rows = listings.join(mine, "ord", "left")
    return rows.withColumn("categories", F.when(F.col("category").isNotNull(), F.array("category")).otherwise(F.col("categories"))).drop("category")


def compared(rules: DataFrame, judged: DataFrame) -> DataFrame:
    """(rule, model, n): first categories of the rules and of the model, counted."""
    first = lambda rows, name: rows.select("ord", F.get("categories", F.lit(0)).alias(name))
    return first(rules, "rule").join(first(judged, "model"), "ord").groupBy("rule", "model").agg(F.count("*").alias("n"))
