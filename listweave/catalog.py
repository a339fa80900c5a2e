"""The registered queries and the SQL that states their results.

Each oracle is written from the rules of the operation over the tables, not
from the Spark code; arrays leave as joined text."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listweave.config import DESCRIPTION_LIMIT, VENUE_MATCH_RATIO
from listweave.functions import places, prices, similarity, timeparse
from listweave.functions import text as texts
from listweave.operators import assist, display, extract, merge, normalize, present, rank, sources, state
from listweave.session import shared_dir
from listweave.streaming import delta
from listweave.tables import stash
from listweave.testview import NOW, SETTINGS, literal_timestamp, oracle, rated, raw, spread

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
TODAY = NOW[:10]


def query(sql: str | None = None):
    """Registers a function under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _all(s: SparkSession, d: str) -> DataFrame:
    return normalize.normalized(raw(s, d, DESCRIPTION_LIMIT), SETTINGS, literal_timestamp())


def _table(s: SparkSession, d: str, *columns: str, wanted: Column | None = None) -> DataFrame:
    """The normalized rows as a table of their own: what follows reads it instead
    of nesting the parsers, and its filters reach the scan. Nothing reads the
    description of a dropped row from it."""
    rows = normalize.normalized(raw(s, d, DESCRIPTION_LIMIT), SETTINGS, literal_timestamp(), describe_dropped=False, wanted=wanted)
    return stash(rows.select(*columns) if columns else rows, "normalized")


def _kept(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return normalize.kept(_table(s, d, *columns, *(["drop_reason"] if columns else []), wanted=F.expr("drop_reason IS NULL")))


#: The rows that ``_ledger_of`` takes, dropped ones too; a row has an id if its start was read.
IN_LEDGER = "ord % 11 = 0 AND {} IS NOT NULL"


def _offered(s: SparkSession, d: str, *columns: str) -> DataFrame:
    """The normalized rows that are kept or in the ledger: all that scoring reads."""
    return _table(s, d, *columns, wanted=F.expr(f"drop_reason IS NULL OR ({IN_LEDGER.format('_start.ts')})"))


def _today():
    return F.lit(TODAY).cast("date")


def _picked(rows: DataFrame, every: int) -> DataFrame:
    """Ids of every so many listings: what users hid, pinned or got sent."""
    return rows.filter(F.col("ord") % every == 0).select("id").distinct()


def _hidden():
    return F.col("hidden")


def _categorized(s, d):
    rows = _kept(s, d)
    return stash(rank.flagged(rank.categorized(rank.with_text(rows), SETTINGS), hidden=_picked(rows, 13)), "categorized")


def _scored(s, d):
    every = _offered(s, d)
    rows = normalize.kept(every)
    return _scored_of(rows, state.sent_ids(rows, state.purged(_ledger_of(every), _today())))


def _scored_of(rows: DataFrame, sent: DataFrame) -> DataFrame:
    some = stash(rank.flagged(rank.categorized(rank.with_text(rows), SETTINGS), hidden=_picked(rows, 13)), "categorized")
    passed = rank.flagged(some.filter(rank.exclusion(SETTINGS, _hidden()).isNull()), sent=sent, pinned=_picked(rows, 101))
    return stash(rank.scored(passed, SETTINGS, literal_timestamp(), F.col("sent"), F.col("pinned")).drop("haystack"), "scored")


def _ledger_of(every: DataFrame) -> DataFrame:
    """A ledger written two days ago: every eleventh listing of all, also past ones."""
    rows = every.filter(IN_LEDGER.format("id"))
    return state.recorded(rows.sparkSession.createDataFrame([], "id string, t string, d date, s date, u date"), rows, F.lit("2024-01-08").cast("date"))


def _final(s, d):
    return _scored(s, d).filter(F.col("score") >= SETTINGS.filters.min_score)


def _viewed(s, d) -> tuple[DataFrame, DataFrame]:
    """The full view, and the ids of what was sent before."""
    every = _offered(s, d)
    rows = normalize.kept(every)
    ids = stash(state.sent_ids(rows, state.purged(_ledger_of(every), _today())), "sent")
    return present.grouped(_final_of(rows, ids), SETTINGS), ids


def _final_of(rows: DataFrame, sent: DataFrame) -> DataFrame:
    return _scored_of(rows, sent).filter(F.col("score") >= SETTINGS.filters.min_score)


# DuckDB: categories, exclusions, scores, groups, each a CTE over the one before.
_WORD = "regexp_matches(txt, '(^|[^\\pL\\pN_]){}($|[^\\pL\\pN_])')".format
VENUE_TOKENS = "trim(regexp_replace(lower(strip_accents({})), '[^0-9a-z]+', ' ', 'g'))".format
#: Venue rules: (place, rule, points) of the one category that has any.
RULES_SQL = "(VALUES " + ", ".join(f"({k}, '{n}', {w}::DOUBLE)" for k, (n, w) in enumerate(SETTINGS.categories["shop"].venue_prior.items())) + ") AS rules(place, rule, points)"
CAT = f"""
places AS MATERIALIZED (SELECT DISTINCT {VENUE_TOKENS('venue_name')} AS a, {VENUE_TOKENS('rule')} AS b FROM (SELECT DISTINCT venue_name FROM listing WHERE venue_name IS NOT NULL), {RULES_SQL}),
{rated('places', 'placed', 85)},
priors AS (SELECT venue_name, arg_min(points, place) AS prior FROM (SELECT DISTINCT venue_name FROM listing) v JOIN placed p ON p.a = {VENUE_TOKENS('venue_name')} JOIN {RULES_SQL} ON p.b = {VENUE_TOKENS('rule')} WHERE ratio >= 85 GROUP BY venue_name),
texts AS (SELECT *, lower(strip_accents(title || ' ' || coalesce(description, ''))) AS txt FROM listing),
points AS (SELECT *,
  CASE WHEN {_WORD('jazz')} THEN 3.0::DOUBLE ELSE 0 END + CASE WHEN regexp_matches(txt, '(^|[^\\pL\\pN_])koncert') THEN 2 ELSE 0 END
    + CASE WHEN contains(url, '/e/u') THEN 3 ELSE 0 END + CASE WHEN native_category = 'click' THEN 4 ELSE 0 END AS music,
  CASE WHEN {_WORD('the')} THEN 0.5::DOUBLE ELSE 0 END + coalesce(prior, 0)
    + CASE WHEN native_category = 'purchase' THEN 4 ELSE 0 END AS shop,
  CASE WHEN native_category = 'view' THEN 4.0::DOUBLE ELSE 0 END AS walk FROM texts LEFT JOIN priors USING (venue_name)),
totals AS (SELECT ord, 'music' AS name, 0 AS place, music AS total FROM points UNION ALL SELECT ord, 'shop', 1, shop FROM points UNION ALL SELECT ord, 'walk', 2, walk FROM points),
named_cats AS (SELECT ord, list(name ORDER BY total DESC, place) AS cats FROM totals WHERE total >= 2 GROUP BY ord),
cat AS (SELECT p.*, coalesce(n.cats, ['egyeb']) AS categories FROM points p LEFT JOIN named_cats n USING (ord))"""
HIDDEN = "hidden AS (SELECT DISTINCT id FROM listing WHERE ord % 13 = 0)"
FILTERED = f"""
{HIDDEN},
reasons AS (SELECT *, CASE WHEN id IN (SELECT id FROM hidden) THEN 'hidden_by_override' WHEN city <> 'Budapest' THEN 'geo_city_mismatch' WHEN distance_km > 6 THEN 'geo_too_far'
  WHEN NOT list_has_any(categories, ['music', 'walk', 'egyeb']) THEN 'category_not_allowed' WHEN price_min > 9000 THEN 'price_too_high'
  WHEN {_WORD('scum')} THEN 'blocked_keyword' END AS reason FROM cat)"""
LEDGER = f"""
ledger AS (SELECT id, title_norm AS t, effective_date AS d, DATE '2024-01-08' AS s, coalesce(CAST("end" AS DATE), effective_date) AS u FROM listing_all WHERE ord % 11 = 0 AND id IS NOT NULL),
protected AS (SELECT * FROM ledger WHERE u >= DATE '{TODAY}')"""
SENT = f"""
{LEDGER},
retold AS MATERIALIZED (SELECT DISTINCT l.title_norm AS a, g.t AS b FROM listing l JOIN protected g ON g.d = l.effective_date),
{rated('retold', 'rated', 92)},
sent AS MATERIALIZED (SELECT id FROM protected UNION SELECT l.id FROM listing l JOIN rated r ON r.a = l.title_norm JOIN protected g ON g.d = l.effective_date AND g.t = r.b WHERE ratio >= 92)"""
SCORED = f"""
{SENT},
pinned AS (SELECT DISTINCT id FROM listing WHERE ord % 101 = 0),
terms AS (SELECT *,
  CASE categories[1] WHEN 'music' THEN 3.0::DOUBLE WHEN 'shop' THEN -1 WHEN 'walk' THEN 1 ELSE 0 END AS category_weight,
  CASE WHEN {_WORD('jazz')} THEN 1.5::DOUBLE ELSE 0 END + CASE WHEN {_WORD('koncert')} THEN 0.5 ELSE 0 END AS keyword_boosts,
  CASE WHEN is_free THEN 2.0::DOUBLE ELSE 0 END AS free_bonus, CASE WHEN price_min < 3000 THEN 1.0::DOUBLE ELSE 0 END AS cheap_bonus,
  CASE WHEN district = 'XI.' THEN 1.25::DOUBLE ELSE 0 END AS same_district_bonus, coalesce(-(least(distance_km, 8.0) * 0.25::DOUBLE), 0) AS distance_penalty,
  CASE WHEN id NOT IN (SELECT id FROM sent) THEN 0.75::DOUBLE ELSE 0 END AS novelty_bonus,
  CASE WHEN "start" BETWEEN TIMESTAMP '{NOW}' AND TIMESTAMP '{NOW}' + INTERVAL 3 DAY THEN 1.5::DOUBLE ELSE 0 END AS soon_bonus,
  CASE isodow(effective_date) WHEN 5 THEN 0.5::DOUBLE WHEN 6 THEN 1 WHEN 7 THEN -0.5 ELSE 0 END AS weekday_weight,
  CASE WHEN id IN (SELECT id FROM pinned) THEN 100.0::DOUBLE ELSE 0 END AS pinned_bonus FROM reasons WHERE reason IS NULL),
scored AS (SELECT *, category_weight + keyword_boosts + free_bonus + cheap_bonus + same_district_bonus + distance_penalty + novelty_bonus + soon_bonus + weekday_weight + pinned_bonus AS score,
  categories[1] AS category FROM terms),
final AS (SELECT * FROM scored WHERE score >= 2)"""
_RANKED = """
slots AS (SELECT *, count(*) OVER (PARTITION BY venue_name, effective_date, category) AS n,
  row_number() OVER (PARTITION BY venue_name, effective_date, category ORDER BY score DESC, ord) AS rk FROM final WHERE venue_name IS NOT NULL)"""
GROUPED = _RANKED + """,
view AS (
  SELECT min(ord) AS ord, substr(sha256('group|' || any_value(venue_norm) || '|' || effective_date || '|' || category), 1, 16) AS id, venue_name || ' — ' || count(*) || ' program' AS title,
    venue_name, effective_date, category, list_distinct_first(flatten(list(categories ORDER BY ord))) AS categories, min("start") AS "start", min_by(start_time_known, rk) AS start_time_known,
    first(district ORDER BY rk) AS district, first(price_min ORDER BY rk) AS price_min, min_by(is_free, rk) AS is_free, max(score) AS score, min_by(pinned_bonus, rk) AS pinned_bonus,
    min_by(url, rk) AS url, string_agg(title, ', ' ORDER BY rk) FILTER (rk <= 3) AS description, count(*) AS group_size
  FROM slots WHERE n >= 4 GROUP BY venue_name, effective_date, category
  UNION ALL SELECT ord, id, title, venue_name, effective_date, category, categories, "start", start_time_known, district, price_min, is_free, score, pinned_bonus, url, description, 1 FROM slots WHERE n < 4 AND rk <= 3
  UNION ALL SELECT ord, id, title, venue_name, effective_date, category, categories, "start", start_time_known, district, price_min, is_free, score, pinned_bonus, url, description, 1 FROM final WHERE venue_name IS NULL)""".replace(
    "list_distinct_first(flatten(list(categories ORDER BY ord)))", "list_reduce([[]::VARCHAR[]] || list(categories ORDER BY ord), lambda a, c: a || list_filter(c, lambda x: NOT list_contains(a, x)))"
)
LIMITED = GROUPED + """,
best AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC, ord) AS rank, min(ord) OVER (PARTITION BY category) AS bucket FROM view WHERE id NOT IN (SELECT id FROM sent)),
limited AS (SELECT * FROM best WHERE rank <= 5 ORDER BY score DESC, bucket DESC, rank DESC LIMIT 6)"""


def _sql(select: str, *ctes: str) -> str:
    return oracle(select, *ctes)


# --- normalize -------------------------------------------------------------


@query(_sql("SELECT * FROM listing_all"))
def normalize_listings(s, d):
    return _all(s, d)


def _columns(name: str, *columns: str) -> None:
    names = ["ord", *columns]
    QUERIES[name] = lambda s, d: _all(s, d).select(*names)
    ORACLES[name] = _sql("SELECT " + ", ".join(f'"{c}"' for c in names) + " FROM listing_all")


_columns("parse_datetime", "start", "start_time_known", "end")
_columns("parse_price", "price_min", "price_max", "is_free")
_columns("normalize_district", "district")
_columns("derive_city", "city")
_columns("effective_date", "effective_date")
_columns("make_event_id", "id")
_columns("normalize_title", "title_norm")
_columns("normalize_venue", "venue_norm")
_columns("normalize_url", "url_norm")
_columns("haversine_km", "distance_km")
_columns("clean_description", "description")
_columns("series_flag", "is_series")


@query("SELECT doc_id, sha256(lower(strip_accents(text))) AS folded FROM documents")
def fold_text(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.sha2(texts.fold_text("text"), 256).alias("folded"))


@query("SELECT p_partkey, trim(regexp_replace(lower(strip_accents(p_name || ' & ' || p_brand)), '[^0-9a-z]+', ' ', 'g')) AS tokens FROM part")
def venue_tokens(s, d):
    return s.read.parquet(f"{d}/part.parquet").select("p_partkey", texts.venue_tokens(F.concat("p_name", F.lit(" & "), "p_brand")).alias("tokens"))


def _dropped(name: str, reason: str) -> None:
    QUERIES[name] = lambda s, d: _table(s, d, "ord", "source_id", "drop_reason").filter(F.col("drop_reason") == reason).select("ord", "source_id")
    ORACLES[name] = _sql(f"SELECT ord, source_id FROM listing_all WHERE drop_reason = '{reason}'")


_dropped("drop_past", "dropped_past")
_dropped("drop_beyond_horizon", "beyond_horizon")
_dropped("drop_unparseable_start", "unparseable_start")


@query(_sql("SELECT source_id, count(*) AS n FROM listing_all WHERE drop_reason = 'dropped_past' GROUP BY source_id"))
def past_by_source(s, d):
    return _table(s, d, "source_id", "drop_reason").filter("drop_reason = 'dropped_past'").groupBy("source_id").agg(F.count("*").alias("n"))


# --- categories, filter, score -----------------------------------------------


_SIGNALS = {
    ("music", "keyword:jazz"): f"CASE WHEN {_WORD('jazz')} THEN 3 END", ("music", "keyword:koncert"): "CASE WHEN regexp_matches(txt, '(^|[^\\pL\\pN_])koncert') THEN 2 END",
    ("music", "url_pattern"): "CASE WHEN contains(url, '/e/u') THEN 3 END", ("music", "native_type"): "CASE WHEN native_category = 'click' THEN 4 END",
    ("shop", "keyword:the"): f"CASE WHEN {_WORD('the')} THEN 0.5 END", ("shop", "venue_prior"): "prior", ("shop", "native_type"): "CASE WHEN native_category = 'purchase' THEN 4 END",
    ("walk", "native_type"): "CASE WHEN native_category = 'view' THEN 4 END",
}


@query(_sql("SELECT * FROM (" + " UNION ALL ".join(f"SELECT ord, '{c}' AS name, {c} AS total, '{n}' AS signal, CAST({x} AS DOUBLE) AS weight FROM points" for (c, n), x in _SIGNALS.items()) + ") WHERE weight IS NOT NULL", CAT))
def explain_category(s, d):
    rows = rank.explained(rank.with_text(_kept(s, d)), SETTINGS)
    scores = rows.select("ord", F.explode("category_scores").alias("c")).select("ord", "c.name", "c.total", F.explode("c.signals").alias("s"))
    return scores.select("ord", "name", "total", "s.signal", "s.weight")


@query(_sql("SELECT venue_name, prior AS weight FROM priors WHERE prior IS NOT NULL", CAT))
def venue_prior_join(s, d):
    return rank.venue_priors(_kept(s, d, "venue_name"), rank.venue_rules(s, SETTINGS)).select("venue_name", "weight")


@query(_sql(f"SELECT 'shop' AS category, rule FROM {RULES_SQL} WHERE {VENUE_TOKENS('rule')} NOT IN (SELECT b FROM placed WHERE ratio >= 85)", CAT))
def unmatched_priors(s, d):
    return rank.unmatched_rules(_kept(s, d, "venue_name"), rank.venue_rules(s, SETTINGS))


@query(_sql("SELECT a.venue_name AS a, b.venue_name AS b FROM (SELECT DISTINCT venue_name FROM listing) a, (SELECT DISTINCT venue_name FROM listing) b, met WHERE a.venue_name < b.venue_name AND met.a = " + VENUE_TOKENS("a.venue_name") + " AND met.b = " + VENUE_TOKENS("b.venue_name") + " AND ratio >= 85",
    f"halls AS (SELECT DISTINCT {VENUE_TOKENS('a.venue_name')} AS a, {VENUE_TOKENS('b.venue_name')} AS b FROM (SELECT DISTINCT venue_name FROM listing) a, (SELECT DISTINCT venue_name FROM listing) b WHERE a.venue_name < b.venue_name)", rated("halls", "met", 85)))
def venue_matches(s, d):
    names = _kept(s, d, "venue_name").filter("venue_name IS NOT NULL").select("venue_name", texts.venue_tokens("venue_name").alias("text")).distinct()
    alike = similarity.similar(names.select("text"), names.select("text"), VENUE_MATCH_RATIO)
    named = lambda n: names.select(F.col("venue_name").alias(f"name_{n}"), F.col("text").alias(n))
    return alike.join(named("a"), "a").join(named("b"), "b").filter("name_a < name_b").select(F.col("name_a").alias("a"), F.col("name_b").alias("b"))


@query(_sql("SELECT ord, array_to_string(categories, ',') AS categories FROM cat", CAT))
def categorize(s, d):
    return _categorized(s, d).select("ord", F.array_join("categories", ",").alias("categories"))


@query(_sql("SELECT c AS category, count(*) AS n FROM (SELECT unnest(categories) AS c FROM cat) GROUP BY c", CAT))
def category_counts(s, d):
    return _categorized(s, d).select(F.explode("categories").alias("category")).groupBy("category").agg(F.count("*").alias("n"))


@query(_sql("SELECT ord, reason FROM reasons", CAT, FILTERED))
def content_filter(s, d):
    return _categorized(s, d).select("ord", rank.exclusion(SETTINGS, _hidden()).alias("reason"))


@query(_sql("SELECT reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY reason", CAT, FILTERED))
def exclusion_counts(s, d):
    rows = _categorized(s, d).select(rank.exclusion(SETTINGS, _hidden()).alias("reason"))
    return rows.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def _only(name: str, keep, reason: str) -> None:
    """One test of the filter by itself."""
    QUERIES[name] = lambda s, d: _categorized(s, d).filter(keep()).select("ord")
    ORACLES[name] = _sql(f"SELECT ord FROM cat WHERE NOT coalesce({reason}, false)", CAT, HIDDEN)


_only("hidden_filter", lambda: ~_hidden(), "id IN (SELECT id FROM hidden)")
_only("geo_distance", lambda: F.coalesce(F.col("distance_km") <= 6.0, F.lit(True)), "distance_km > 6")
_only("geo_city", lambda: F.coalesce(texts.fold_text("city") == "budapest", F.lit(True)), "city <> 'Budapest'")
_only("category_allow", lambda: F.arrays_overlap("categories", F.array(*map(F.lit, SETTINGS.filters.categories))), "NOT list_has_any(categories, ['music', 'walk', 'egyeb'])")
_only("price_cap", lambda: F.coalesce(F.col("price_min") <= 9000, F.lit(True)), "price_min > 9000")
_only("blocked_keywords", lambda: ~texts.contains_word(F.col("haystack"), "scum", prefix_by_default=False), _WORD("scum"))


@query(_sql("SELECT doc_id, regexp_matches(t, '(^|[^\\pL\\pN_])licen') AS prefix, regexp_matches(t, '(^|[^\\pL\\pN_])und($|[^\\pL\\pN_])') AS whole FROM (SELECT doc_id, lower(strip_accents(text)) AS t FROM documents)"))
def contains_word(s, d):
    rows = s.read.parquet(f"{d}/documents.parquet").select("doc_id", texts.fold_text("text").alias("t"))
    return rows.select("doc_id", texts.contains_word(F.col("t"), "licen*").alias("prefix"), texts.contains_word(F.col("t"), "und").alias("whole"))


_TERMS = "category_weight, keyword_boosts, free_bonus, cheap_bonus, same_district_bonus, distance_penalty, novelty_bonus, soon_bonus, weekday_weight, pinned_bonus"


@query(_sql(f"SELECT ord, {_TERMS}, round(score, 6) AS score FROM scored", CAT, FILTERED, SCORED))
def explain_score(s, d):
    return _scored(s, d).select("ord", *_TERMS.split(", "), F.round("score", 6).alias("score"))


@query(_sql("SELECT ord, round(score, 6) AS score FROM final", CAT, FILTERED, SCORED))
def min_score(s, d):
    return _final(s, d).select("ord", F.round("score", 6).alias("score"))


# --- groups, limits, sections ---------------------------------------------------

_VIEW = """id, title, url, "start", start_time_known, effective_date, venue_name AS venue, district, array_to_string(categories, ',') AS categories, price_min, is_free, round(score - pinned_bonus, 6) AS score, group_size"""


@query(_sql(f"SELECT {_VIEW} FROM view", CAT, FILTERED, SCORED, GROUPED))
def publish_full(s, d):
    rows = present.published(present.grouped(_final(s, d), SETTINGS))
    return rows.withColumns({"score": F.round("score", 6), "categories": F.array_join("categories", ",")})


@query(_sql('SELECT id, "start", round(score - pinned_bonus, 6) AS score, row_number() OVER (ORDER BY score DESC, "start", ord) AS place FROM view', CAT, FILTERED, SCORED, GROUPED))
def site_order(s, d):
    view = stash(present.grouped(_final(s, d), SETTINGS), "view")
    placed = sources.numbered(view, ["score", "start", "ord"], [True, False, False], "place")
    return placed.select("id", "start", F.round(F.col("score") - F.col("pinned_bonus"), 6).alias("score"), "place")


@query(_sql("SELECT effective_date, count(*) AS n FROM view GROUP BY effective_date", CAT, FILTERED, SCORED, GROUPED))
def day_separators(s, d):
    return present.day_counts(present.grouped(_final(s, d), SETTINGS))


@query(_sql("SELECT title, description, group_size, round(score, 6) AS score FROM view WHERE group_size > 1", CAT, FILTERED, SCORED, GROUPED))
def group_collapse(s, d):
    return present.grouped(_final(s, d), SETTINGS).filter("group_size > 1").select("title", "description", "group_size", F.round("score", 6).alias("score"))


@query(_sql("SELECT ord, category FROM final WHERE venue_name IS NULL", CAT, FILTERED, SCORED))
def group_passthrough(s, d):
    return present.grouped(_final(s, d), SETTINGS).filter("venue_name IS NULL").select("ord", "category")


@query(_sql("SELECT ord FROM slots WHERE n < 4 AND rk <= 3", CAT, FILTERED, SCORED, _RANKED))
def venue_cap(s, d):
    return present.grouped(_final(s, d), SETTINGS).filter("venue_name IS NOT NULL AND group_size = 1").select("ord")


@query(_sql("SELECT ord, category, rank FROM limited", CAT, FILTERED, SCORED, LIMITED))
def email_delta_rows(s, d):
    return _delta(s, d).select("ord", "category", "rank")


def _delta(s, d):
    """What the mail shows: the full view without what was sent, cut to its limits."""
    view, sent = _viewed(s, d)
    return present.limited(state.unsent(view, sent), SETTINGS)


@query(_sql("SELECT category, CASE category WHEN 'music' THEN 1 WHEN 'shop' THEN 2 WHEN 'walk' THEN 3 ELSE 5 END AS section, count(*) AS n FROM limited GROUP BY 1, 2", CAT, FILTERED, SCORED, LIMITED))
def section_order(s, d):
    rows = present.sectioned(_delta(s, d), SETTINGS)
    return rows.groupBy("category", "section").agg(F.count("*").alias("n"))


@query(_sql(f"SELECT ord, date_diff('day', DATE '{TODAY}', effective_date) AS days_left FROM view WHERE group_size = 1 AND date_diff('day', DATE '{TODAY}', effective_date) BETWEEN 0 AND 3", CAT, FILTERED, SCORED, GROUPED))
def expiring_soon(s, d):
    return present.expiring(present.grouped(_final(s, d), SETTINGS), SETTINGS, _today()).select("ord", "days_left")


@query(_sql(f"SELECT count(*) AS shown, count(*) FILTER (is_free) AS free, count(*) FILTER (effective_date = DATE '{TODAY}') AS tonight, arg_max(title, (score, -ord)) AS top FROM final", CAT, FILTERED, SCORED))
def digest_counters(s, d):
    return _final(s, d).agg(
        F.count("*").alias("shown"), F.count_if("is_free").alias("free"), F.count_if(F.col("effective_date") == _today()).alias("tonight"),
        F.max_by("title", F.struct("score", -F.col("ord"))).alias("top"),
    )


# --- interactive view -------------------------------------------------------------

_CONDITIONS = "list_has_any(categories, ['music'])", "effective_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'", "(is_free OR coalesce(price_min = 0, false))", "coalesce(district = 'XI.', false)"


def _conditions():
    return present.filters(categories=["music"], since="2024-01-10", until="2024-01-14", free=True, district="XI.")


@query(_sql(f"SELECT ord FROM final WHERE {' AND '.join(_CONDITIONS)}", CAT, FILTERED, SCORED))
def apply_filters(s, d):
    return present.applied(_final(s, d), _conditions()).select("ord")


@query(_sql("SELECT without, n FROM (SELECT *, row_number() OVER (ORDER BY n DESC, k) AS r FROM (" + " UNION ALL ".join(f"SELECT {k} AS k, '{n}' AS without, count(*) FILTER ({' AND '.join(c for j, c in enumerate(_CONDITIONS) if j != k)}) AS n FROM final" for k, n in enumerate(("categories", "dates", "free", "district"))) + ") WHERE n > 0) WHERE r <= 3", CAT, FILTERED, SCORED))
def relax_suggestions(s, d):
    return present.relaxed(_final(s, d), _conditions())


@query(_sql("SELECT district, count(*) AS n, count(*) FILTER (is_free) AS free FROM final WHERE district IS NOT NULL GROUP BY district", CAT, FILTERED, SCORED))
def facets_present(s, d):
    return _final(s, d).filter("district IS NOT NULL").groupBy("district").agg(F.count("*").alias("n"), F.count_if("is_free").alias("free"))


_LABELS = "CASE c WHEN 'egyeb' THEN 'Egyéb' ELSE c END"
_HAY = f"lower(strip_accents(title || ' ' || coalesce(venue_name || ' ', '') || array_to_string(list_transform(categories, lambda c: {_LABELS}), ' ')))"


@query(_sql(f"SELECT ord FROM final WHERE contains({_HAY}, 'asia')", CAT, FILTERED, SCORED))
def search_text(s, d):
    return present.searched(_final(s, d), "asia").select("ord")


@query(_sql(f"SELECT ord FROM final WHERE contains({_HAY}, 'egyeb')", CAT, FILTERED, SCORED))
def search_labels(s, d):
    return present.searched(_final(s, d), " EGYÉB").select("ord")


# --- duplicates ----------------------------------------------------------------------

_CLUSTERS = """
lead AS (SELECT *, CASE source_id WHEN 's0' THEN 10 WHEN 's1' THEN 20 WHEN 's2' THEN 30 ELSE 1000 END AS p, {} AS cluster FROM listing),
flagged AS (SELECT *, coalesce(p < min(p) OVER (PARTITION BY cluster ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS leads FROM lead),
ordered AS (SELECT *, CASE WHEN leads THEN 1000000000000 + ord ELSE -ord END AS pref FROM flagged),
merged AS (SELECT cluster, min(ord) AS ord, count(*) AS records,
  list_reduce([[]::VARCHAR[]] || list([source_id] ORDER BY pref DESC), lambda a, c: a || list_filter(c, lambda x: NOT list_contains(a, x))) AS source_ids,
  list_reduce([[]::VARCHAR[]] || list([url] ORDER BY pref DESC), lambda a, c: a || list_filter(c, lambda x: NOT list_contains(a, x))) AS urls,
  list_reduce([[]::VARCHAR[]] || list([native_category] ORDER BY pref DESC), lambda a, c: a || list_filter(c, lambda x: NOT list_contains(a, x))) AS native_categories,
  arg_max(title, pref) AS title, arg_max(source_id, pref) AS base_source, arg_max(venue_name, pref) FILTER (venue_name IS NOT NULL) AS venue_name,
  arg_max(district, pref) FILTER (district IS NOT NULL) AS district, arg_max("end", pref) FILTER ("end" IS NOT NULL) AS "end", arg_max(image_url, pref) FILTER (image_url IS NOT NULL) AS image_url,
  arg_max(price_min, pref) FILTER (price_min IS NOT NULL) AS price_min, coalesce(arg_max(is_free, pref) FILTER (price_min IS NOT NULL), arg_max(is_free, pref)) AS is_free,
  arg_max(distance_km, pref) FILTER (lat IS NOT NULL) AS distance_km, length(arg_max(description, (coalesce(length(description), -1), pref))) AS description_length
  FROM ordered GROUP BY cluster)""".format
_LISTS = ("source_ids", "urls", "native_categories")
_FIELDS = "ord, records, {}, title, venue_name, district, \"end\", image_url, price_min, is_free, distance_km, description_length".format
_MERGED = "SELECT " + _FIELDS(", ".join(f"array_to_string({n}, ',') AS {n}" for n in _LISTS)) + " FROM merged"


def _shown(out: DataFrame) -> DataFrame:
    lists = [F.array_join(n, ",").alias(n) for n in _LISTS]
    return out.select("ord", "records", *lists, "title", "venue_name", "district", "end", "image_url", "price_min", "is_free", "distance_km", F.length("description").alias("description_length"))


def _listed(s, d):
    return merge.listed(_kept(s, d))


def _once(s, d):
    """Listings after the exact stage."""
    rows = _listed(s, d)
    return stash(merge.merged(rows.withColumn("cluster", F.col("id")), SETTINGS).drop("cluster", "records"), "exact")


def _distinct(s, d):
    """Listings after the exact and the URL stage."""
    rows = _once(s, d)
    return stash(merge.merged(rows.join(merge.url_clusters(rows), "ord"), SETTINGS).drop("cluster", "records"), "distinct")


@query(_sql(_MERGED, _CLUSTERS("id")))
def dedup_exact(s, d):
    return _shown(merge.merged(_listed(s, d).withColumn("cluster", F.col("id")), SETTINGS))


@query(_sql("SELECT ord, min(ord) OVER (PARTITION BY url_norm) AS cluster FROM listing"))
def dedup_url(s, d):
    return merge.url_clusters(_listed(s, d))


@query(_sql(_MERGED, _CLUSTERS("min(ord) OVER (PARTITION BY url_norm)")))
def merge_fold(s, d):
    rows = _listed(s, d)
    return _shown(merge.merged(rows.join(merge.url_clusters(rows), "ord"), SETTINGS))


@query()
def dedup_fuzzy(s, d):
    """Clusters of the fuzzy stage, after the exact and the URL stage; an
    order-dependent fold with changing records, tested against the fold itself."""
    rows = _distinct(s, d)
    return merge.fuzzy_clusters(rows, SETTINGS)


@query(_sql("SELECT count(*) AS before, count(DISTINCT id) AS after, count(*) - count(DISTINCT id) AS merged FROM listing"))
def merge_counts(s, d):
    return _kept(s, d, "id").agg(F.count("*").alias("before"), F.count_distinct("id").alias("after")).withColumn("merged", F.col("before") - F.col("after"))


_NEAR = "CASE WHEN a.start_time_known AND b.start_time_known THEN abs(date_diff('second', a.\"start\", b.\"start\")) <= 5400 ELSE CAST(a.\"start\" AS DATE) = CAST(b.\"start\" AS DATE) END"


@query(_sql(f"SELECT a.ord AS a, b.ord AS b FROM listing a JOIN listing b ON a.venue_name = b.venue_name AND a.ord < b.ord WHERE {_NEAR}"))
def start_gate(s, d):
    return merge.start_pairs(_kept(s, d, "ord", "venue_name", "start", "start_time_known"), "venue_name")


_TAILED = """
tailed AS MATERIALIZED (SELECT ord, title, venue_name, venue_norm, title_norm, "start", start_time_known, nullif(regexp_extract(title, '^.*\\s[|-]\\s+(.*)$', 1), '') AS last FROM listing),
lasts AS (SELECT DISTINCT lower(strip_accents(last)) AS a, venue_norm AS b FROM tailed WHERE last IS NOT NULL AND venue_norm <> ''),
""" + rated("lasts", "suffix", 85).strip() + """,
titled AS MATERIALIZED (SELECT t.*, CASE WHEN ratio >= 85 THEN trim(regexp_replace(regexp_replace(lower(strip_accents(regexp_extract(title, '^(.*\\S)\\s+[|-]\\s+.*$', 1))), '(\\s*\\(\\s*([^()\\s]+(\\s+[^()\\s]+)?\\s*)?\\)\\s*)+$', ''), '\\s+', ' ', 'g')) ELSE title_norm END AS fuzzy
  FROM tailed t LEFT JOIN suffix x ON x.a = lower(strip_accents(last)) AND x.b = venue_norm AND ratio >= 85)"""


@query(_sql("SELECT ord, fuzzy FROM titled", _TAILED))
def fuzzy_title(s, d):
    return merge.fuzzy_titles(_kept(s, d, "ord", "title", "venue_name")).select("ord", "fuzzy")


_HALLS = f"halls AS MATERIALIZED (SELECT DISTINCT {VENUE_TOKENS('a.venue_name')} AS a, {VENUE_TOKENS('b.venue_name')} AS b FROM (SELECT DISTINCT venue_name FROM listing) a, (SELECT DISTINCT venue_name FROM listing) b WHERE a.venue_name IS NOT NULL AND b.venue_name IS NOT NULL)"
_MET = f"""
{rated('halls', 'met', 85)},
tokened AS MATERIALIZED (SELECT *, {VENUE_TOKENS('venue_name')} AS place FROM titled),
gated AS MATERIALIZED (SELECT a.ord AS a_ord, b.ord AS b_ord, a.fuzzy AS a, b.fuzzy AS b FROM tokened a JOIN tokened b ON a.ord < b.ord AND CAST(b."start" AS DATE) BETWEEN CAST(a."start" AS DATE) - 1 AND CAST(a."start" AS DATE) + 1
  WHERE {_NEAR} AND (a.venue_name IS NULL OR b.venue_name IS NULL OR (a.place, b.place) IN (SELECT (a, b) FROM met WHERE ratio >= 85))),
wordings AS MATERIALIZED (SELECT DISTINCT a, b FROM gated),
{rated('wordings', 'worded', 80)},
fuzzy_pairs AS (SELECT a_ord AS a, b_ord AS b, ratio FROM gated g JOIN worded w ON w.a = g.a AND w.b = g.b WHERE ratio >= 80)"""


def _pairs(s, d):
    rows = _kept(s, d, "ord", "title", "venue_name", "start", "start_time_known")
    return merge.fuzzy_pairs(merge.comparable(rows), forms=False)


@query(_sql("SELECT a, b, round(ratio, 6) AS ratio FROM fuzzy_pairs WHERE ratio < 88", _TAILED, _HALLS, _MET))
def ambiguous_pairs(s, d):
    return _pairs(s, d).filter(F.col("ratio") < 88).select("a", "b", F.round("ratio", 6).alias("ratio"))


@query(_sql("SELECT a, b FROM fuzzy_pairs WHERE ratio >= 88", _TAILED, _HALLS, _MET))
def venue_gate(s, d):
    """Pairs that pass all three: start, venue and title."""
    return _pairs(s, d).filter(F.col("ratio") >= 88).select("a", "b")


@query(_sql("SELECT count(*) AS pairs, count(*) FILTER (CAST(a.\"start\" AS DATE) = CAST(b.\"start\" AS DATE)) AS same_day, count(*) FILTER (abs(date_diff('second', a.\"start\", b.\"start\")) <= 5400) AS within_gap FROM listing a JOIN listing b ON a.ord < b.ord AND a.source_id <> b.source_id"))
def candidate_pair_counts(s, d):
    return merge.pair_counts(_kept(s, d, "source_id", "start"))


# --- ledger, health, run ----------------------------------------------------------------


def _ledger(s, d):
    return _ledger_of(_offered(s, d, "ord", "id", "title_norm", "effective_date", "end"))


@query(_sql("SELECT DISTINCT id FROM sent WHERE id IN (SELECT id FROM listing)", SENT))
def was_sent(s, d):
    every = _offered(s, d, "ord", "id", "title_norm", "effective_date", "end", "drop_reason")
    return state.sent_ids(normalize.kept(every), state.purged(_ledger_of(every), _today()))


@query(_sql("SELECT ord FROM listing WHERE id NOT IN (SELECT id FROM sent)", SENT))
def exclude_already_sent(s, d):
    every = _offered(s, d, "ord", "id", "title_norm", "effective_date", "end", "drop_reason")
    rows = normalize.kept(every)
    return state.unsent(rows, state.sent_ids(rows, state.purged(_ledger_of(every), _today()))).select("ord")


@query(_sql(f"SELECT id, t, d, s, u FROM ledger UNION ALL SELECT id, title_norm, effective_date, DATE '{TODAY}', coalesce(CAST(\"end\" AS DATE), effective_date) FROM listing", LEDGER))
def ledger_record(s, d):
    every = _offered(s, d, "ord", "id", "title_norm", "effective_date", "end", "drop_reason")
    return state.recorded(_ledger_of(every), normalize.kept(every), _today())


@query(_sql("SELECT id, t, d, s, u FROM protected", LEDGER))
def ledger_purge(s, d):
    return state.purged(_ledger(s, d), _today())


@query(_sql("SELECT id FROM limited", CAT, FILTERED, SCORED, LIMITED))
def ledger_scope(s, d):
    """What a run records that counts only what the mail shows."""
    view, sent = _viewed(s, d)
    shown = present.limited(state.unsent(view, sent), SETTINGS)
    return state.scope(view, shown, True, SETTINGS.replace(ledger_scope="email")).select("id")


# Sources here are (source, hour) slices of the raw listings: some of them fail, some come back empty.
_SLICES = "slices AS (SELECT source_id || '-' || (ord // 500) AS source_id, count(*) AS raw, count(*) FILTER (drop_reason IS NULL) AS n FROM listing_all GROUP BY 1)"
_BEFORE = "before AS (SELECT source_id, raw % 7 AS consecutive_failures, DATE '2024-01-01' AS last_ok, raw % 20 AS last_count, CASE WHEN raw % 3 = 0 THEN DATE '2024-01-05' + CAST(raw % 10 AS INTEGER) END AS disabled_until FROM slices)"
_AFTER = f"""ran AS (SELECT b.*, n, disabled_until IS NULL OR disabled_until <= DATE '{TODAY}' AS due, source_id LIKE '%7' AS failed FROM before b JOIN slices USING (source_id)),
after AS (SELECT source_id, CASE WHEN NOT due THEN consecutive_failures WHEN failed THEN consecutive_failures + 1 ELSE 0 END AS consecutive_failures,
  CASE WHEN due AND NOT failed THEN DATE '{TODAY}' ELSE last_ok END AS last_ok, CASE WHEN due AND NOT failed THEN n ELSE last_count END AS last_count,
  CASE WHEN NOT due THEN disabled_until WHEN failed THEN CASE WHEN consecutive_failures + 1 >= 5 THEN DATE '{TODAY}' + 7 ELSE disabled_until END END AS disabled_until,
  due AND NOT failed AND n = 0 AND last_count > 10 AS drifted FROM ran)"""


def _slices(s, d):
    rows = _table(s, d, "ord", "source_id", "drop_reason").withColumn("source_id", F.concat_ws("-", "source_id", F.floor(F.col("ord") / 500).cast("string")))
    counts = rows.groupBy("source_id").agg(F.count("*").alias("raw"), F.count_if(F.col("drop_reason").isNull()).alias("n"))
    before = counts.select(
        "source_id", (F.col("raw") % 7).alias("consecutive_failures"), F.lit("2024-01-01").cast("date").alias("last_ok"), (F.col("raw") % 20).alias("last_count"),
        F.when(F.col("raw") % 3 == 0, F.date_add(F.lit("2024-01-05").cast("date"), (F.col("raw") % 10).cast("int"))).alias("disabled_until"),
    )
    due = state.due(before, _today())
    run = counts.join(due.select("source_id"), "source_id", "left_semi").select("source_id", F.when(~F.col("source_id").endswith("7"), F.col("n")).alias("n"))
    return before, state.health(before, run, _today())


@query(_sql("SELECT * FROM after", _SLICES, _BEFORE, _AFTER))
def health_update(s, d):
    return _slices(s, d)[1]


@query(_sql("SELECT source_id FROM after WHERE drifted", _SLICES, _BEFORE, _AFTER))
def drift_detect(s, d):
    return _slices(s, d)[1].filter("drifted").select("source_id")


@query(_sql(f"SELECT source_id FROM before WHERE disabled_until > DATE '{TODAY}'", _SLICES, _BEFORE))
def source_skip(s, d):
    before = _slices(s, d)[0]
    return before.join(state.due(before, _today()), "source_id", "left_anti").select("source_id")


@query(_sql("SELECT source_id, coalesce(CAST(last_ok AS VARCHAR), '—') AS last_ok, coalesce(CAST(last_count AS VARCHAR), '—') AS last_count, coalesce(CAST(disabled_until AS VARCHAR), '—') AS disabled_until, consecutive_failures FROM after", _SLICES, _BEFORE, _AFTER))
def status_rows(s, d):
    return state.status(_slices(s, d)[1])


@query(_sql("SELECT count(*) AS sources, count(*) FILTER (consecutive_failures = 0) AS working FROM after", _SLICES, _BEFORE, _AFTER))
def health_line(s, d):
    return state.health_line(_slices(s, d)[1])


@query(_sql("SELECT source_id, count(*) AS raw, count(*) FILTER (drop_reason IS NULL) AS kept, count(*) FILTER (drop_reason = 'dropped_past') AS past, count(*) FILTER (drop_reason IS NULL AND venue_name IS NULL) AS venueless FROM listing_all GROUP BY source_id"))
def run_summary(s, d):
    none = F.col("drop_reason").isNull()
    return _table(s, d, "source_id", "venue_name", "drop_reason").groupBy("source_id").agg(
        F.count("*").alias("raw"), F.count_if(none).alias("kept"), F.count_if(F.col("drop_reason") == "dropped_past").alias("past"),
        F.count_if(none & F.col("venue_name").isNull()).alias("venueless"),
    )


# --- extraction: bodies are built from the tables, one per nation -----------------------


#: A body holds at most so many records, however large a source is.
BODY_ROWS = 100


def _bodies(s, d, body) -> DataFrame:
    rows = spread(s.read.parquet(f"{d}/customer.parquet")).withColumn("source_id", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    rows = rows.withColumn("capture", F.floor(F.col("c_custkey") / BODY_ROWS))
    url = F.concat(F.lit("https://ex.com/list/"), F.first("c_nationkey").cast("string"), F.lit("/page?n=1"))
    return rows.groupBy("source_id", "capture").agg(body.alias("body"), url.alias("capture_url"))


_CUSTOMER = "SELECT 'n' || c_nationkey AS source_id, CAST(c_custkey AS VARCHAR) AS key, c_name AS name FROM customer"


def _items():
    return F.collect_list(F.struct(F.col("c_custkey").alias("key"), F.struct(F.col("c_name").alias("name")).alias("venue")))


@query(_CUSTOMER)
def extract_json_array(s, d):
    bodies = _bodies(s, d, F.to_json(F.struct(F.struct(_items().alias("items")).alias("data"))))
    return extract.json_array(bodies, "data.items", {"key": "key", "name": "venue.name"}).drop("position")


@query(_CUSTOMER)
def extract_array_json(s, d):
    return extract.json_array(_bodies(s, d, F.to_json(_items())), "", {"key": "key", "name": "venue.name"}).drop("position")


@query(_CUSTOMER)
def extract_keyed_json(s, d):
    pairs = F.map_from_entries(F.collect_list(F.struct(F.col("c_custkey").cast("string"), F.struct(F.col("c_name").alias("name")))))
    return extract.keyed_json(_bodies(s, d, F.to_json(pairs)), {"name": "name"})


@query(_CUSTOMER)
def extract_jsonld(s, d):
    items = F.collect_list(F.struct(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).alias("item")))
    block = F.to_json(F.struct(F.lit("list").alias("@id"), items.alias("itemListElement")))
    page = F.concat(F.lit('<html><script type="application/ld+json">{"broken</script><script type="application/ld+json">'), block, F.lit("</script></html>"))
    return extract.jsonld(_bodies(s, d, page), ["list"], {"key": "key", "name": "name"})


@query("SELECT 'n' || c_nationkey AS source_id, CASE WHEN c_acctbal < 0 THEN 'missing_name' END AS reject_reason, count(*) AS n FROM customer GROUP BY ALL")
def rejects(s, d):
    name = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    items = F.collect_list(F.struct(F.col("c_custkey").alias("key"), name.alias("name")))
    rows = extract.json_array(_bodies(s, d, F.to_json(items)), "", {"key": "key", "name": "name"})
    return extract.split_rejects(rows, ["key", "name"]).groupBy("source_id", "reject_reason").agg(F.count("*").alias("n"))


_EDGE = """SELECT 'n' || c_nationkey AS source_id, CAST(c_custkey AS VARCHAR) AS key, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'no_start' WHEN c_custkey % 7 = 0 THEN 'online' WHEN c_nationkey > 12 THEN 'out_of_area' END AS reject_reason FROM customer"""


@query(_EDGE)
def extract_edges_json(s, d):
    key = F.col("c_custkey")
    node = F.struct(key.alias("key"), F.when(key % 5 != 0, "2024-01-12T19:00:00").alias("start"), (key % 7 == 0).alias("online"), F.struct(F.col("c_name").alias("name"), F.when(F.col("c_nationkey") > 12, "Szeged").otherwise("Budapest").alias("city")).alias("venue"))
    edges = F.collect_list(F.struct(node.alias("node")))
    bodies = _bodies(s, d, F.to_json(F.struct(F.struct(F.struct(edges.alias("edges")).alias("events")).alias("data"))))
    rows = extract.json_array(bodies, "data.events.edges", {"key": "node.key", "name": "node.venue.name", "start": "node.start", "online": "node.online", "city": "node.venue.city"})
    rules = [("no_start", F.col("start").isNull()), ("online", F.col("online") == "true"), ("out_of_area", F.col("city") != "Budapest")]
    return extract.ruled_out(rows, rules).select("source_id", "key", "name", "reject_reason")


@query("""SELECT 'n' || c_nationkey AS source_id, CAST(c_custkey AS VARCHAR) AS key, 'boardgame' AS native_category FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND c_nationkey <= 12""")
def extract_calendar_json(s, d):
    key = F.col("c_custkey")
    item = F.struct(key.alias("id"), F.when(key % 5 == 0, "cancelled").otherwise("confirmed").alias("status"), F.struct(F.when(key % 7 != 0, "2024-01-12T19:00:00+01:00").alias("dateTime")).alias("start"), F.concat(F.lit("Hall, "), F.when(F.col("c_nationkey") > 12, "6720 Szeged").otherwise("1117 Budapest")).alias("location"))
    bodies = _bodies(s, d, F.to_json(F.struct(F.collect_list(item).alias("items"))))
    rows = extract.json_array(bodies, "items", {"key": "id", "status": "status", "start": "start.dateTime", "location": "location"})
    area = places.derive_city(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("location"))
    rules = [("cancelled", F.col("status") == "cancelled"), ("all_day", F.col("start").isNull()), ("out_of_area", F.coalesce(area, F.lit("")) != "Budapest")]
    return extract.ruled_out(rows, rules).filter("reject_reason IS NULL").select("source_id", "key", F.lit("boardgame").alias("native_category"))


@query("SELECT 'n' || c_nationkey AS source_id, CAST(c_custkey AS VARCHAR) AS number, CASE WHEN c_custkey % 3 <> 0 THEN 'true' END AS flag, CAST(NULL AS VARCHAR) AS wrong FROM customer")
def extract_json_field(s, d):
    item = F.struct(F.struct(F.col("c_custkey").alias("n"), F.when(F.col("c_custkey") % 3 != 0, True).alias("b")).alias("a"), F.lit("x").alias("s"))
    return extract.json_array(_bodies(s, d, F.to_json(F.collect_list(item))), "", {"number": "a.n", "flag": "a.b", "wrong": "s.deeper.still"}).drop("position")


_MAPPING = {
    "title": {"path": "venue.name", "transforms": ["html_unescape", "strip", "lower", "truncate:14"]},
    "url": {"path": "link", "absolute": True},
    "price_raw": {"path": "balance", "transforms": ["regex:^-?(\\d+)\\.(\\d+):1"], "optional": True},
    "start_raw": {"path": "start", "optional": True},
}
_MAPPED = """
SELECT 'n' || c_nationkey AS source_id, left(lower(trim(' ' || c_name || ' & Co ')), 14) AS title,
  CASE c_custkey % 4 WHEN 0 THEN 'https://ex.com/c/' || c_custkey WHEN 1 THEN 'https://ex.com/list/' || c_nationkey || '/c' || c_custkey WHEN 2 THEN 'http://other.hu/' || c_custkey END AS url,
  CASE WHEN c_custkey % 6 <> 0 THEN regexp_extract(b, '^-?(\\d+)\\.(\\d+)', 1) END AS price_raw, CASE WHEN c_custkey % 4 = 3 THEN 'missing_url' END AS reject_reason
FROM (SELECT *, CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS b FROM customer)"""


def _mapped(s, d):
    key = F.col("c_custkey").cast("string")
    link = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("/c/"), key)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("c"), key)).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("http://other.hu/"), key)).otherwise("")
    balance = F.when(F.col("c_custkey") % 6 != 0, F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    item = F.struct(F.struct(F.concat(F.lit("  "), "c_name", F.lit(" &amp; Co ")).alias("name")).alias("venue"), link.alias("link"), balance.alias("balance"))
    return sources.mapped(extract.items_of(_bodies(s, d, F.to_json(F.collect_list(item))), ""), _MAPPING)


@query(f"SELECT * FROM ({_MAPPED}) WHERE reject_reason IS NULL")
def map_to_raw(s, d):
    return _mapped(s, d).filter("reject_reason IS NULL").select("source_id", "title", "url", "price_raw", "reject_reason")


@query(f"SELECT source_id, reject_reason, count(*) AS n FROM ({_MAPPED}) GROUP BY ALL")
def transforms(s, d):
    """Rows of a mapping by the reason of their rejection."""
    return _mapped(s, d).groupBy("source_id", "reject_reason").agg(F.count("*").alias("n"))


@query("SELECT row_number() OVER (ORDER BY event_id % 4, event_id // 100, event_id) AS ord, 's' || (event_id % 4) AS source_id, event_id, CASE WHEN event_id % 4 = 1 THEN value END AS value FROM events")
def union_sources(s, d):
    """Captures of four sources, of which only one has a value, in one order."""
    events = spread(s.read.parquet(f"{d}/events.parquet"))
    rows = events.select(F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string")).alias("source_id"), F.floor(F.col("event_id") / 100).alias("capture"), (F.col("event_id") % 100).alias("position"), "event_id", "value")
    tables = [rows.filter(F.col("source_id") == f"s{k}") for k in range(4)]
    return sources.united([t if k == 1 else t.drop("value") for k, t in enumerate(tables)]).select("ord", "source_id", "event_id", "value")


# --- the delta view as a stream -----------------------------------------------------------

_PARTS = 3
_TOLD = f"""
arrived AS (SELECT *, ord * {_PARTS} // (SELECT count(*) FROM events) AS part FROM listing),
same_day AS MATERIALIZED (SELECT DISTINCT l.title_norm AS a, g.title_norm AS b FROM arrived l JOIN arrived g ON g.effective_date = l.effective_date AND g.part < l.part),
{rated('same_day', 'told', 92)},
likes AS MATERIALIZED (SELECT a, b FROM told WHERE ratio >= 92),
batch0 AS MATERIALIZED (SELECT * FROM arrived WHERE part = 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1)""" + "".join(
    f""",
seen{k} AS MATERIALIZED (SELECT id, title_norm, effective_date FROM ({' UNION ALL '.join(f'SELECT * FROM batch{j}' for j in range(k))}) WHERE coalesce(CAST("end" AS DATE), effective_date) >= DATE '{TODAY}'),
known{k} AS MATERIALIZED (SELECT id FROM seen{k} UNION SELECT a.id FROM arrived a JOIN likes ON likes.a = a.title_norm JOIN seen{k} g ON g.effective_date = a.effective_date AND g.title_norm = likes.b WHERE a.part = {k}),
batch{k} AS MATERIALIZED (SELECT * FROM arrived WHERE part = {k} AND id NOT IN (SELECT id FROM known{k}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1)"""
    for k in range(1, _PARTS)
)


@query(_sql(" UNION ALL ".join(f"SELECT ord, id, {k}::BIGINT AS batch FROM batch{k}" for k in range(_PARTS)), _TOLD.strip()))
def delta_stream(s, d):
    """Raw listings arrive in three parts; the stream ends after each and goes on
    from its checkpoint."""
    rows = stash(raw(s, d), "raw")
    total = s.read.parquet(f"{d}/events.parquet").agg(F.count("*").alias("total"))
    parted = rows.join(F.broadcast(total)).withColumn("part", F.floor(F.col("ord") * _PARTS / F.col("total"))).drop("total")  # one row
    folder = f"{shared_dir(s)}/stream-{uuid.uuid4().hex}"
    for k in range(_PARTS):
        parted.filter(F.col("part") == k).drop("part").write.mode("append").parquet(f"{folder}/raw")
        delta.delta_stream(s, f"{folder}/raw", rows.schema, folder, SETTINGS, literal_timestamp()).awaitTermination()
    return delta.delivered(s, folder, T.StructType.fromDDL("ord long, id string"))


# --- rule tables and the assist steps -------------------------------------------------------

_KEYWORDS = "SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN left(p_name, 4) || '*' ELSE split_part(p_name, ' ', 2) || '$' END AS keyword FROM part"


@query(_sql("SELECT ord, keyword FROM listing JOIN hits USING (title)", f"""
held AS MATERIALIZED (SELECT title, keyword FROM (SELECT DISTINCT title FROM listing) t JOIN ({_KEYWORDS}) k ON contains(lower(strip_accents(title)), rtrim(keyword, '*$'))),
hits AS MATERIALIZED (SELECT * FROM held WHERE regexp_matches(lower(strip_accents(title)), '(^|[^\\pL\\pN_])' || rtrim(keyword, '*$') || CASE WHEN right(keyword, 1) = '*' OR (right(keyword, 1) <> '$' AND length(keyword) >= 5) THEN '' ELSE '($|[^\\pL\\pN_])' END))""".strip()))
def keyword_join(s, d):
    """Every part gives a keyword: a phrase, a prefix or a whole word."""
    name, key = F.col("p_name"), F.col("p_partkey") % 3
    rules = s.read.parquet(f"{d}/part.parquet").select(F.when(key == 0, name).when(key == 1, F.concat(F.left(name, F.lit(4)), F.lit("*"))).otherwise(F.concat(F.split_part(name, F.lit(" "), F.lit(2)), F.lit("$"))).alias("keyword"))
    listings = _kept(s, d, "ord", "title").select(F.col("ord").alias("key"), texts.fold_text("title").alias("haystack"))
    return rank.keyword_matches(listings, rules).withColumnRenamed("key", "ord")


_ASKED = f"""
once AS MATERIALIZED (SELECT *, sha256(title || chr(10) || coalesce(description, '')) AS content_hash FROM cat QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1),
asked AS (SELECT * FROM once WHERE categories = ['egyeb'] AND length(description) > 200),
cache AS (SELECT DISTINCT content_hash, 'walk' AS category FROM asked WHERE ord % 9 = 0),
reps AS (SELECT content_hash, min(ord) AS ord, arg_min(id, ord) AS id FROM asked WHERE content_hash NOT IN (SELECT content_hash FROM cache) GROUP BY content_hash),
plan AS (SELECT *, (row_number() OVER (ORDER BY ord) - 1) // {SETTINGS.assist_batch_size} AS batch FROM reps),
replies AS (SELECT batch, id, content_hash, CASE ord % 5 WHEN 0 THEN 'music' WHEN 1 THEN 'walk' WHEN 2 THEN 'opera' END AS category FROM plan WHERE ord % 5 < 4),
answered AS (SELECT content_hash, category FROM replies WHERE category IN ('music', 'shop', 'walk') UNION ALL SELECT * FROM cache),
judged AS (SELECT o.ord, o.id, o.categories AS before, CASE WHEN n.category IS NOT NULL THEN [n.category] ELSE o.categories END AS categories FROM once o LEFT JOIN asked a ON a.ord = o.ord LEFT JOIN answered n ON n.content_hash = a.content_hash)"""


def _assisted(s, d):
    """(listings, those asked about, cache, plan); one listing of each id."""
    rows = _categorized(s, d).drop("hidden")
    first = rows.groupBy("id").agg(F.min("ord").alias("ord"))
    once = stash(rows.drop("haystack").join(first.select("ord"), "ord", "left_semi"), "once")
    asked = assist.eligible(once, SETTINGS)
    cache = stash(asked.filter("ord % 9 = 0").select(assist.content_hash().alias("content_hash"), F.lit("walk").alias("category")).distinct(), "cache")
    return once, asked, cache, stash(assist.batch_plan(asked, cache, SETTINGS), "plan")


def _answers(plan: DataFrame) -> DataFrame:
    """What a model might reply: fenced objects with names, unknown names, numbers
    and gaps; one per batch, which holds a batch's rows at most."""
    name = F.when(F.col("ord") % 5 == 0, '"music"').when(F.col("ord") % 5 == 1, '"walk"').when(F.col("ord") % 5 == 2, '"opera"').otherwise("7")
    pair = F.when(F.col("ord") % 5 < 4, F.concat(F.lit('"'), "id", F.lit('": '), name))
    text = F.concat(F.lit("```json\n{"), F.array_join(F.collect_list(pair), ", "), F.lit("}\n```"))
    return assist.answers(plan.groupBy("batch").agg(text.alias("text")))


@query(_sql("SELECT ord, content_hash FROM asked", CAT, _ASKED))
def llm_eligible(s, d):
    return _assisted(s, d)[1].select("ord", assist.content_hash().alias("content_hash"))


@query(_sql("SELECT content_hash, id, ord, batch FROM plan", CAT, _ASKED))
def llm_batch_plan(s, d):
    return _assisted(s, d)[3].drop("called")


@query(_sql("SELECT batch, id, category FROM replies WHERE category IS NOT NULL", CAT, _ASKED))
def llm_parse_response(s, d):
    return _answers(_assisted(s, d)[3])


def _judged(s, d):
    once, asked, cache, plan = _assisted(s, d)
    return once, assist.applied(once, asked, cache.unionByName(assist.named(plan, _answers(plan), SETTINGS)))


@query(_sql("SELECT ord, array_to_string(categories, ',') AS categories FROM judged", CAT, _ASKED))
def llm_apply(s, d):
    return _judged(s, d)[1].select("ord", F.array_join("categories", ",").alias("categories"))


@query(_sql("SELECT before[1] AS rule, categories[1] AS model, count(*) AS n FROM judged GROUP BY ALL", CAT, _ASKED))
def llm_compare(s, d):
    return assist.compared(*_judged(s, d))


@query(_sql("""SELECT (SELECT count(*) FROM listing_all) AS raw, (SELECT count(*) FROM listing_all WHERE drop_reason = 'dropped_past') AS dropped_as_past,
  (SELECT count(*) FROM reasons WHERE reason IS NOT NULL) AS dropped_by_content, (SELECT count(*) FROM reasons WHERE reason LIKE 'geo%') AS dropped_by_geo,
  (SELECT count(*) FROM scored) - (SELECT count(*) FROM final) AS dropped_by_min_score, (SELECT count(*) FROM final WHERE venue_name IS NULL) AS ungrouped_venueless,
  (SELECT count(*) FROM view) AS published, (SELECT count(*) FROM view WHERE id IN (SELECT id FROM sent)) AS suppressed_by_ledger, (SELECT count(*) FROM limited) AS sent""", CAT, FILTERED, SCORED, LIMITED))
def fork_views(s, d):
    """One materialised parent of both views, and the run's counters on the way. The
    counters are of all raw listings, so every row is in the table."""
    every = _table(s, d)
    rows = normalize.kept(every)
    ids = stash(state.sent_ids(rows, state.purged(_ledger_of(every), _today())), "sent")
    some = stash(rank.flagged(rank.categorized(rank.with_text(rows), SETTINGS), hidden=_picked(rows, 13)).withColumn("reason", rank.exclusion(SETTINGS, _hidden())), "categorized")
    passed = rank.flagged(some.filter("reason IS NULL"), sent=ids, pinned=_picked(rows, 101))
    scored = stash(rank.scored(passed, SETTINGS, literal_timestamp(), F.col("sent"), F.col("pinned")).drop("haystack"), "scored")
    kept = scored.filter(F.col("score") >= SETTINGS.filters.min_score)
    view = stash(present.grouped(kept, SETTINGS), "view")
    fresh = stash(present.limited(state.unsent(view, ids), SETTINGS), "delta")
    count = lambda df, **tests: df.agg(*[F.count_if(c).alias(n) for n, c in tests.items()]).select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in tests])).alias("c")).select("c.*")
    yes = F.lit(True)
    counts = [
        count(every, raw=yes, dropped_as_past=F.col("drop_reason") == "dropped_past"),
        count(some, dropped_by_content=F.col("reason").isNotNull(), dropped_by_geo=F.col("reason").startswith("geo")),
        count(scored, dropped_by_min_score=F.col("score") < SETTINGS.filters.min_score, ungrouped_venueless=(F.col("score") >= SETTINGS.filters.min_score) & F.col("venue_name").isNull()),
        count(view, published=yes), count(view.join(ids, "id", "left_semi"), suppressed_by_ledger=yes), count(fresh, sent=yes),
    ]
    names = ["raw", "dropped_as_past", "dropped_by_content", "dropped_by_geo", "dropped_by_min_score", "ungrouped_venueless", "published", "suppressed_by_ledger", "sent"]
    return reduce(DataFrame.union, counts).agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


# --- what a reader sees ------------------------------------------------------------


_MONTHS_SQL = "(['" + "', '".join(timeparse.MONTHS) + "'])[month({0})] || ' ' || day({0}) || '.'"
_DAYS_SQL = "CASE date_diff('day', DATE '{1}', {0}) WHEN 0 THEN 'ma' WHEN 1 THEN 'holnap' ELSE (['" + "', '".join(display.WEEKDAYS) + "'])[isodow({0})] END || ', ' || " + _MONTHS_SQL
_WHEN = _DAYS_SQL.format("effective_date", TODAY)


@query(_sql(f"""SELECT id, CASE WHEN group_size > 1 THEN 'Egy helyszín, több program · ' || group_size || ' program · ' || {_WHEN}
    ELSE {_WHEN} || CASE WHEN start_time_known THEN ', ' || strftime("start", '%H:%M') ELSE '' END END AS when_label,
  year(effective_date) || '. ' || {_MONTHS_SQL.format('effective_date')} AS full_date, array_to_string(list_transform(categories, lambda c: {_LABELS}), ', ') AS category_labels,
  CAST(least(7, greatest(0, ceil(score / 2))) AS INTEGER) AS score_bar,
  CASE WHEN CAST("start" AS DATE) <> effective_date THEN 'éjjel, ' || (['{"', '".join(display.WEEKDAYS_DATIVE)}'])[isodow("start")] END AS night_note,
  concat_ws(' · ', nullif(venue_name, ''), nullif(district, '') || ' kerület', CASE WHEN is_free THEN 'ingyenes' WHEN price_min IS NULL THEN 'ár nincs megadva' ELSE replace(format('{{:,}}', price_min), ',', ' ') || ' Ft' END) AS meta_text FROM view""", CAT, FILTERED, SCORED, GROUPED))
def label_columns(s, d):
    rows = display.labelled(present.grouped(_final(s, d), SETTINGS), _today())
    return rows.select("id", "when_label", "full_date", "category_labels", "score_bar", "night_note", "meta_text")


@query(_sql("SELECT c AS category, count(*) AS n FROM (SELECT unnest(categories) AS c FROM cat) WHERE c <> 'egyeb' GROUP BY c", CAT))
def missing_labels(s, d):
    return display.unlabelled(_categorized(s, d))


@query(_sql(f"SELECT 'Budapest — ' || year(DATE '{TODAY}') || '. ' || {_MONTHS_SQL.format(f"DATE '{TODAY}'")} || ': ' || CASE count(*) WHEN 0 THEN 'ma nincs semmi' ELSE count(*) || ' új program' END AS subject FROM limited", CAT, FILTERED, SCORED, LIMITED))
def subject_line(s, d):
    return display.subject(_delta(s, d), _today())


@query(_sql('SELECT id, row_number() OVER (ORDER BY "start", score DESC, ord) AS place FROM view', CAT, FILTERED, SCORED, GROUPED))
def user_sort(s, d):
    view = stash(present.grouped(_final(s, d), SETTINGS).select("id", "start", "score", "ord"), "view")
    return sources.numbered(view, ["start", "score", "ord"], [False, True, False], "place").select("id", "place")


@query(_sql(f"""SELECT ord, away = 0 AS today, away = 1 AS tomorrow, away BETWEEN 0 AND 7 AS week, away BETWEEN 0 AND 7 AND isodow(effective_date) IN (5, 6, 7) AS weekend
  FROM (SELECT *, date_diff('day', DATE '{TODAY}', effective_date) AS away FROM listing)"""))
def filter_date_range(s, d):
    rows = _kept(s, d, "ord", "effective_date")
    return rows.select("ord", *[present.date_range(n, _today()).alias(n) for n in ("today", "tomorrow", "week", "weekend")])


@query(_sql("SELECT ord FROM listing WHERE is_free OR price_min IS NULL OR price_min <= 3000"))
def filter_price_cap(s, d):
    return present.applied(_kept(s, d, "ord", "is_free", "price_min"), present.filters(max_price=3000)).select("ord")


@query(_sql("SELECT ord FROM listing WHERE is_free OR price_min = 0"))
def filter_free(s, d):
    return present.applied(_kept(s, d, "ord", "is_free", "price_min"), present.filters(free=True)).select("ord")


@query("SELECT CAST(o_orderdate AS DATE) AS run, count(*) AS shown FROM orders GROUP BY ALL ORDER BY run DESC LIMIT 30")
def run_log_retention(s, d):
    """A log with a run for each day of orders."""
    orders = s.read.parquet(f"{d}/orders.parquet")
    return state.kept_runs(orders.groupBy(F.col("o_orderdate").cast("date").alias("run")).agg(F.count("*").alias("shown")), "run")


# --- fields that single sources need ---------------------------------------------------


@query(_sql("SELECT ord, CASE WHEN x.a IS NOT NULL THEN regexp_extract(title, '^(.*\\S)\\s+[|-]\\s+.*$', 1) ELSE title END AS stripped FROM tailed t LEFT JOIN suffix x ON x.a = lower(strip_accents(last)) AND x.b = venue_norm AND ratio >= 85", _TAILED))
def strip_venue_suffix(s, d):
    rows = _kept(s, d, "ord", "title", "venue_name")
    return rows.select("ord", merge.strip_venue_suffix("title", "venue_name").alias("stripped"))


def _events(s, d, **fields: str) -> DataFrame:
    """``events`` with text fields written in SQL that both dialects read."""
    rows = s.read.parquet(f"{d}/events.parquet").withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    return rows.select("event_id", "ts", *[F.expr(sql).alias(n) for n, sql in fields.items()])


def _told(**fields: str) -> str:
    return "(SELECT event_id, ts, " + ", ".join(f"{sql} AS {n}" for n, sql in fields.items()) + " FROM (SELECT * REPLACE (date_trunc('minute', ts) AS ts) FROM events))"


_PART = "lpad(CAST({}(ts) AS STRING), 2, '0')".format
_DAY_TEXT, _CLOCK_TEXT = f"CAST(CAST(ts AS DATE) AS STRING)", f"{_PART('hour')} || ':' || {_PART('minute')}"
_END = dict(ending=f"CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'soon' WHEN event_id % 13 = 0 THEN '- 02. 30. 10:00' WHEN event_id % 17 = 0 THEN ' - 02. 29. 10:00 ' WHEN event_id % 3 = 0 THEN ' - 01. 02. 03:04' ELSE ' - ' || {_PART('month')} || '. ' || {_PART('day')} || '. ' || lpad(CAST(event_id % 24 AS STRING), 2, '0') || ':30' END")
_SPLIT_START = dict(
    marker=f"CASE WHEN event_id % 9 = 0 THEN {_DAY_TEXT} WHEN event_id % 10 = 0 THEN NULL ELSE {_DAY_TEXT} || 'T12:00:00.000Z' END",
    clock=f"CASE event_id % 8 WHEN 0 THEN '24:10' WHEN 1 THEN ' 9:05 ' WHEN 2 THEN '9:5' WHEN 3 THEN NULL WHEN 4 THEN '19:60' ELSE {_CLOCK_TEXT} END",
)
_MIDNIGHT = dict(stated=f"{_DAY_TEXT} || 'T' || CASE WHEN event_id % 3 = 0 THEN '00:00' ELSE {_CLOCK_TEXT} END || ':00'", prose="CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'tomorrow at 7' END")
_FEE = dict(amount="CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(event_id % 5000 AS STRING) END", currency="CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'EUR' END")


@query(f"""SELECT event_id, strftime(CASE WHEN same < ts THEN later ELSE same END, '%Y-%m-%d %H:%M:%S') AS ending FROM (
  SELECT event_id, ts, try_strptime(year(ts) || ' ' || told, '%Y %m. %d. %H:%M') AS same, try_strptime((year(ts) + 1) || ' ' || told, '%Y %m. %d. %H:%M') AS later
  FROM (SELECT event_id, ts, CASE WHEN NOT contains(ending, '02. 29.') THEN trim(ltrim(trim(ending), '-')) END AS told FROM {_told(**_END)}))""")
def resolve_year(s, d):
    return _events(s, d, **_END).select("event_id", timeparse.resolve_year("ending", F.col("ts")).alias("ending"))


@query(f"""SELECT event_id, CASE WHEN contains(marker, 'T') AND regexp_full_match(trim(clock), '\\d{{1,2}}:\\d\\d') AND CAST(split_part(trim(clock), ':', 1) AS INT) < 24 AND CAST(split_part(trim(clock), ':', 2) AS INT) < 60
  THEN left(marker, 10) || ' ' || lpad(split_part(trim(clock), ':', 1), 2, '0') || ':' || split_part(trim(clock), ':', 2) || ':00' END AS "start" FROM {_told(**_SPLIT_START)}""")
def combine_start(s, d):
    return _events(s, d, **_SPLIT_START).select("event_id", timeparse.combine_start("marker", "clock").alias("start"))


@query(f"""SELECT event_id, CASE WHEN NOT contains(stated, 'T00:00:00') THEN stated WHEN trim(coalesce(prose, '')) <> '' THEN left(stated, 10) END AS "start",
  CASE WHEN contains(stated, 'T00:00:00') AND trim(coalesce(prose, '')) = '' THEN 'placeholder_start' END AS reject_reason FROM {_told(**_MIDNIGHT)}""")
def placeholder_clock(s, d):
    start, reason = timeparse.placeholder_clock("stated", "prose")
    return _events(s, d, **_MIDNIGHT).select("event_id", start.alias("start"), reason.alias("reject_reason"))


@query(f"SELECT event_id, CASE WHEN amount <> '' THEN amount || ' ' || CASE WHEN currency <> '' THEN currency ELSE 'HUF' END END AS price_raw FROM {_told(**_FEE)}")
def price_from_parts(s, d):
    return _events(s, d, **_FEE).select("event_id", prices.price_from_parts("amount", "currency").alias("price_raw"))


@query("SELECT page_id, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '')[2] AS category FROM pages")
def url_category(s, d):
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", texts.url_category("url").alias("category"))


_CALENDAR = dict(
    told="CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN text || chr(10) || chr(10) || 'JOIN with Google Meet' || chr(10) || 'https://ex.com/x' WHEN 2 THEN '<br><a href=\"x\">' || replace(replace(text, '<', ''), '&', '') || '</a> &amp; more' ELSE ' Csatlakozás a Google Meet szolgáltatással: x' END",
    location="CASE doc_id % 6 WHEN 0 THEN 'Club A - Budapest, Fo utca 12345, 9999, 1117 Budapest' WHEN 1 THEN '' WHEN 2 THEN 'Hall – BUDAPEST , 1243 x, 1052' WHEN 3 THEN '6720 Szeged' WHEN 4 THEN NULL ELSE 'Budapest Hall' END",
)


@query(f"""SELECT doc_id, sha256(nullif(trim(regexp_replace(CASE WHEN contains(cut, '<') THEN replace(regexp_replace(cut, '<[^>]*>', ' ', 'gs'), '&amp;', '&') ELSE cut END, '\\s+', ' ', 'g')), '')) AS description,
  nullif(trim(regexp_replace(split_part(location, ',', 1), '\\s*[-–]\\s*Budapest\\s*$', '', 'i')), '') AS venue,
  list_filter(regexp_extract_all(location, '\\b(\\d{{4}})\\b', 1), lambda z: left(z, 1) = '1' AND CAST(substr(z, 2, 2) AS INT) BETWEEN 1 AND 23)[1] AS zip
  FROM (SELECT doc_id, location, regexp_replace(told, '\\n*(Csatlakozás a Google Meet szolgáltatással|Join with Google Meet)\\b.*', '', 'is') AS cut FROM (SELECT doc_id, {', '.join(f"{x} AS {n}" for n, x in _CALENDAR.items())} FROM documents))""")
def calendar_cleanup(s, d):
    rows = s.read.parquet(f"{d}/documents.parquet").select("doc_id", *[F.expr(x.replace("chr(10)", "char(10)")).alias(n) for n, x in _CALENDAR.items()])
    described = F.sha2(extract.calendar_description(F.col("told")), 256)
    return rows.select("doc_id", described.alias("description"), extract.calendar_venue(F.col("location")).alias("venue"), extract.calendar_zip(F.col("location")).alias("zip"))
