"""Rows out of captured JSON and HTML bodies, on Columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.functions import places, text

# How a calendar's own conferencing footer begins.
CALENDAR_FOOTERS = ("Csatlakozás a Google Meet szolgáltatással", "Join with Google Meet")


def json_array(captures: DataFrame, path: str, fields: dict[str, str]) -> DataFrame:
    """Items of the array at ``path`` of each body, one row each; a path that
    leads to no array gives no row. ``fields``: column -> dotted path in an item."""
    items = F.try_variant_get(F.try_parse_json("body"), f"$.{path}" if path else "$", "array<variant>")
    rows = captures.select("source_id", F.posexplode(items).alias("position", "item"))
    return rows.select("source_id", "position", *[F.try_variant_get("item", f"$.{p}", "string").alias(n) for n, p in fields.items()])


def keyed_json(captures: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Records of an object that is keyed by id; the key is the record's own id
    unless it states another."""
    records = F.from_json("body", "map<string,variant>")
    rows = captures.select("source_id", F.explode(records).alias("key", "item"))
    own = F.try_variant_get("item", "$.id", "string")
    return rows.select("source_id", F.coalesce(own, "key").alias("key"), *[F.try_variant_get("item", f"$.{p}", "string").alias(n) for n, p in fields.items()])


def jsonld(captures: DataFrame, ids: list[str], fields: dict[str, str]) -> DataFrame:
    """List items of the linked-data blocks of a page whose @id is among ``ids``;
    blocks that do not parse are skipped."""
    blocks = F.regexp_extract_all("body", F.lit(r'(?s)<script type="application/ld\+json">(.*?)</script>'), F.lit(1))
    block = captures.select("source_id", F.explode(blocks).alias("text")).withColumn("block", F.try_parse_json("text"))
    wanted = block.filter(F.try_variant_get("block", "$.@id", "string").isin(ids))
    items = F.try_variant_get("block", "$.itemListElement", "array<variant>")
    rows = wanted.select("source_id", F.explode(items).alias("item"))
    return rows.select("source_id", *[F.try_variant_get("item", f"$.item.{p}", "string").alias(n) for n, p in fields.items()])


def split_rejects(rows: DataFrame, required: list[str]) -> DataFrame:
    """``rows`` with ``reject_reason``: the first required column without a value."""
    reason = F.lit(None).cast("string")
    for name in reversed(required):
        reason = F.when(F.coalesce(F.trim(name), F.lit("")) == "", f"missing_{name}").otherwise(reason)
    return rows.withColumn("reject_reason", reason)


def items_of(captures: DataFrame, path: str) -> DataFrame:
    """(source_id, capture_url, position, item) of the array at ``path``."""
    items = F.try_variant_get(F.try_parse_json("body"), f"$.{path}" if path else "$", "array<variant>")
    return captures.select("source_id", "capture_url", F.posexplode(items).alias("position", "item"))


def ruled_out(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """``rows`` with ``reject_reason``: the first rule that holds, null if none does."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(rules):
        reason = F.when(F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    return rows.withColumn("reject_reason", reason)


def calendar_description(raw: Column) -> Column:
    """The text before the conferencing footer, without tags, blanks collapsed;
    null where nothing is left."""
    text_ = F.regexp_replace(raw, "(?isu)\\n*(?:" + "|".join(CALENDAR_FOOTERS) + ")\\b.*", "")
    plain = F.when(text_.contains("<"), text.html_unescape(F.regexp_replace(text_, "(?s)<[^>]*>", " "))).otherwise(text_)
    return F.nullif(text.collapse_space(plain), F.lit(""))


def calendar_venue(location: Column) -> Column:
    """What stands before the first comma, without the city at its end."""
    first = F.substring_index(location, ",", 1)
    return text.empty_to_null(F.regexp_replace(first, r"(?iU)\s*[-–]\s*Budapest\s*$", ""))


def calendar_zip(location: Column) -> Column:
    """The first word of four digits that is a district's postal code."""
    return F.get(F.filter(places.words(location), lambda w: places.district_from_zip(w).isNotNull()), F.lit(0))
