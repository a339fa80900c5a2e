"""Listings derived from the given tables, as one SQL text for both dialects.

Every ``events`` row becomes a raw listing of one of four sources; every tenth
is a near copy of its neighbour. ``LISTING`` states, for the oracles, what
normalizing them must give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listweave.config import CategoryRules, Filters, Home, Scoring, Settings
from listweave.functions.places import DISTRICTS
from listweave.functions.text import shortened

NOW = "2024-01-10 09:00:00"
SETTINGS = Settings(
    categories={
        "music": CategoryRules(keywords={"jazz": 3.0, "koncert": 2.0}, native_types=("click",), url_patterns=("/e/u",)),
        "shop": CategoryRules(keywords={"the": 0.5}, native_types=("purchase",), venue_prior={"Asia bolt!": 3.0, "asia": 2.5, "nowhere hall": 9.0, "africa  widge": 1.25, "Europa gear": 0.75}),
        "walk": CategoryRules(native_types=("view",)),
    },
    home=Home("XI.", 47.45, 19.03),
    scoring=Scoring(
        category_weights={"music": 3.0, "shop": -1.0},
        keyword_boosts={"jazz": 1.5, "koncert$": 0.5},
        free_bonus=2.0, cheap_under=3000, cheap_points=1.0,
        distance_penalty_per_km=0.25, same_district_bonus=1.25, penalty_cap_km=8.0,
        novelty_bonus=0.75, soon_within_days=3, soon_points=1.5,
        weekday_weights={"fri": 0.5, "sat": 1.0, "sun": -0.5},
    ),
    filters=Filters(categories=("music", "walk", "egyeb"), max_price=9000, blocked_keywords=("scum",), min_score=2.0, city="Budapest", max_distance_km=6.0),
    source_priorities={"s0": 10, "s1": 20, "s2": 30},
    total_limit=6,
)

_ROMANS = ", ".join(f"'{d}'" for d in DISTRICTS)


def raw_sql(spark: bool) -> str:
    """CTEs up to ``raw``."""
    div = (lambda a, b: f"({a} DIV {b})") if spark else (lambda a, b: f"({a} // {b})")
    if spark:
        fmt = lambda x, java, c: f"date_format({x}, \"{java}\")"
        days = lambda d, n: f"date_add({d}, CAST({n} AS INT))"
        numeral = f"element_at(array({_ROMANS}), CAST(event_id % 23 + 1 AS INT))"
        few, hint = "(SELECT * FROM part WHERE p_partkey BETWEEN -16 AND 16)", "/*+ BROADCAST(p2) */ "  # all keys that a remainder by 17 can have
    else:
        fmt = lambda x, java, c: f"strftime({x}, '{c}')"
        days = lambda d, n: f"({d} + CAST({n} AS INTEGER))"
        numeral = f"([{_ROMANS}])[event_id % 23 + 1]"
        few, hint = "part", ""
    s = "CAST({} AS STRING)".format
    price = "CAST(floor(value * 100) AS BIGINT)"
    return f"""
base AS (
  SELECT event_id, date_trunc('minute', ts) AS ts, user_id, event_type, value,
    CASE WHEN event_id % 10 = 5 THEN event_id - 1 ELSE event_id END AS b, {div('event_id', 10)} AS d10,
    (SELECT count(*) FROM part) AS np, (SELECT count(*) FROM documents) AS nd
  FROM events),
keyed AS (SELECT *, (b * 7) % np AS k1, b % 17 AS k2, (b * 13) % np AS k3, b % 5 AS k4, event_id % nd AS k5 FROM base),
named AS (
  SELECT {hint}k.*, p1.p_name || ' ' || p2.p_name AS t, d.text,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE r.r_name || ' ' || split_part(p3.p_name, ' ', 2) END AS venue
  FROM keyed k JOIN part p1 ON p1.p_partkey = k1 JOIN {few} p2 ON p2.p_partkey = k2 JOIN part p3 ON p3.p_partkey = k3
  JOIN region r ON r.r_regionkey = k4 JOIN documents d ON d.doc_id = k5),
raw AS (
  SELECT event_id AS ord, 's' || {s('event_id % 4')} AS source_id,
    CASE WHEN event_id % 10 <> 5 THEN t WHEN d10 % 4 = 0 THEN t || ' (HU)' WHEN d10 % 4 = 1 THEN upper(t)
      WHEN d10 % 4 = 2 THEN t || ' | ' || coalesce(venue, 'x') ELSE replace(t, 'a', 'á') END AS title,
    venue AS venue_name,
    CASE WHEN event_id % 2 = 0 THEN 'HTTPS://Ex.com/e/' ELSE 'https://ex.com/e/' END
      || CASE WHEN event_id % 10 < 3 THEN {s('d10')} ELSE 'u' || {s('event_id')} END
      || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/' ELSE '?utm_source=feed#top' END AS url,
    CASE WHEN event_id % 97 = 0 THEN 'soon' WHEN event_id % 53 = 0 THEN {fmt('ts', 'yyyy.MM.dd.', '%Y.%m.%d.')}
      WHEN event_id % 4 = 0 THEN {fmt('ts', "yyyy-MM-dd'T'HH:mm:ss", '%Y-%m-%dT%H:%M:%S')}
      WHEN event_id % 4 = 1 THEN {fmt('ts', "yyyy-MM-dd'T'HH:mm:ss", '%Y-%m-%dT%H:%M:%S')} || '+01:00'
      WHEN event_id % 4 = 2 THEN {fmt('ts', 'yyyy. MM. dd. HH:mm', '%Y. %m. %d. %H:%M')}
      ELSE {fmt('ts', 'yyyy', '%Y')} || '. január ' || {fmt('ts', 'dd', '%d')} || '., szombat ' || {fmt('ts', 'HH:mm', '%H:%M')} END AS start_raw,
    CASE WHEN event_id % 6 = 0 THEN {s(days('CAST(ts AS DATE)', 'event_id % 13'))} END AS end_raw,
    CASE WHEN event_id % 5 <> 3 THEN '1' || lpad({s('event_id % 30')}, 2, '0') || '3' END AS postal_code,
    CASE event_id % 7 WHEN 1 THEN 'Szeged' WHEN 2 THEN ' BUDAPEST, XI. ker ' WHEN 3 THEN ' ' END AS city,
    CASE event_id % 4 WHEN 1 THEN '1117 Budapest, Fo utca 2.' WHEN 2 THEN 'Fo utca 3, BUDAPEST' WHEN 3 THEN '8600 Siofok, Budapest ut 5.' END AS address_raw,
    CASE WHEN event_id % 3 = 0 THEN 'https://ex.com/i/' || {s('event_id')} || '.jpg' END AS image_url,
    CASE event_id % 4 WHEN 0 THEN {numeral} || '.' WHEN 1 THEN {s('event_id % 30')} WHEN 2 THEN {s('event_id % 25')} || '. kerület' END AS district_raw,
    CASE WHEN event_id % 3 <> 0 THEN CAST(47.40 AS DOUBLE) + CAST(user_id % 100 AS DOUBLE) / 1000 END AS lat,
    CASE WHEN event_id % 3 <> 0 THEN CAST(19.00 AS DOUBLE) + CAST(user_id % 70 AS DOUBLE) / 1000 END AS lon,
    CASE event_id % 5 WHEN 0 THEN 'ingyenes' WHEN 1 THEN CASE WHEN {price} >= 1000 THEN {s(div(price, 1000))} || ' ' || lpad({s(f'{price} % 1000')}, 3, '0') ELSE {s(price)} END || ' Ft'
      WHEN 2 THEN '2000-4500 Ft' WHEN 4 THEN '?' END AS price_raw,
    CASE WHEN event_id % 4 = 0 THEN 'Jazz  koncert ' ELSE '' END || text AS description,
    event_type AS native_category
  FROM named)"""


def spread(rows: DataFrame) -> DataFrame:
    """A table of fewer file splits than there are cores, dealt out while its
    rows are still narrow: what follows is parsing, not reading."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def raw(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    """The raw listings. With a limit, texts are shortened to what decides a
    description of so many characters, once each and before listings share them."""
    names = ("events", "part", "region", "documents")
    frames = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    frames["events"] = spread(frames["events"])
    if limit is not None:
        frames["documents"] = frames["documents"].select("doc_id", shortened("text", limit).alias("text"))
    text = f"WITH {', '.join(f'{n} AS (SELECT * FROM {{{n}_}})' for n in names)}, {raw_sql(True)} SELECT * FROM raw"
    return spark.sql(text, **{f"{n}_": f for n, f in frames.items()})


def literal_timestamp(text: str = NOW):
    return F.lit(text).cast("timestamp_ntz")


_FOLD = "lower(strip_accents({}))".format
_TITLE = "trim(regexp_replace(regexp_replace({}, '(\\s*\\(\\s*([^()\\s]+(\\s+[^()\\s]+)?\\s*)?\\)\\s*)+$', ''), '\\s+', ' ', 'g'))".format
_HOME = SETTINGS.home

#: DuckDB: what the raw listings are once normalized, with the reason of a drop.
LISTING = f"""
parsed AS (
  SELECT *,
    CASE WHEN regexp_full_match(start_raw, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\+01:00)?') THEN try_strptime(left(start_raw, 19), '%Y-%m-%dT%H:%M:%S')
      WHEN regexp_full_match(start_raw, '\\d{{4}}\\. \\d\\d\\. \\d\\d\\. \\d\\d:\\d\\d') THEN try_strptime(start_raw, '%Y. %m. %d. %H:%M')
      WHEN contains(start_raw, 'január') THEN try_strptime(replace(replace(start_raw, 'január', '01'), 'szombat ', ''), '%Y. %m %d., %H:%M')
      WHEN regexp_full_match(start_raw, '\\d{{4}}\\.\\d\\d\\.\\d\\d\\.') THEN try_strptime(start_raw, '%Y.%m.%d.') END AS "start",
    NOT regexp_full_match(start_raw, '\\d{{4}}\\.\\d\\d\\.\\d\\d\\.') AS known0,
    CAST(CAST(end_raw AS DATE) AS TIMESTAMP) AS "end",
    trim(regexp_replace(replace(replace(replace(description, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')) AS plain,
    coalesce(nullif(postal_code, ''), nullif(regexp_extract(address_raw, '(^|\\D)(\\d{{4}})(\\D|$)', 2), '')) AS zip,
    {_TITLE(_FOLD('title'))} AS title_norm, coalesce({_FOLD('venue_name')}, '') AS venue_norm,
    coalesce(regexp_matches(lower(price_raw), 'ingyenes|free|díjtalan|dijtalan'), false) AS is_free,
    list_transform(regexp_extract_all(regexp_replace(coalesce(price_raw, ''), '(\\d)[\\s.]+(\\d)', '\\1\\2', 'g'), '\\d+'), lambda x: CAST(x AS BIGINT)) AS amounts,
    CASE WHEN CAST(substr(postal_code, 2, 2) AS INTEGER) BETWEEN 1 AND 23 THEN ([{_ROMANS}])[CAST(substr(postal_code, 2, 2) AS INTEGER)] || '.' END AS zip_district,
    CASE WHEN regexp_matches(district_raw, '^[IVX]') THEN district_raw
      WHEN CAST(regexp_extract(district_raw, '^\\d+') AS VARCHAR) <> '' AND TRY_CAST(regexp_extract(district_raw, '^\\d+') AS INTEGER) BETWEEN 1 AND 23
        THEN ([{_ROMANS}])[TRY_CAST(regexp_extract(district_raw, '^\\d+') AS INTEGER)] || '.' END AS own_district
  FROM raw),
listing_all AS (
  SELECT ord, source_id, title, title_norm, venue_norm, url, venue_name, native_category, image_url, "start", "end", lat, lon,
    nullif(CASE WHEN length(plain) <= 400 THEN plain ELSE rtrim(coalesce(nullif(regexp_extract(left(plain, 400), '(?s)^(.+) ', 1), ''), left(plain, 400))) END, '') AS description,
    CASE WHEN "start" IS NOT NULL THEN known0 END AS start_time_known,
    CASE WHEN "start" IS NOT NULL THEN CAST(CASE WHEN known0 THEN "start" - INTERVAL 5 HOUR ELSE "start" END AS DATE) END AS effective_date,
    CASE WHEN "start" IS NOT NULL THEN substr(sha256(title_norm || '|' || strftime("start", '%Y-%m-%d') || '|' || venue_norm), 1, 16) END AS id,
    regexp_replace(lower(regexp_extract(url, '^[^/]*//[^/?#]*')) || regexp_extract(url, '^[^/]*//[^/?#]*([^?#]*)', 1), '/+$', '') AS url_norm,
    CASE WHEN trim(city) <> '' THEN CASE WHEN regexp_matches(lower(trim(city)), '^budapest($|\\W)') THEN 'Budapest' ELSE trim(city) END
      WHEN zip IS NOT NULL THEN CASE WHEN left(zip, 1) = '1' AND CAST(substr(zip, 2, 2) AS INTEGER) BETWEEN 1 AND 23 THEN 'Budapest' END
      WHEN regexp_matches(lower(address_raw), '(^|\\W)budapest($|\\W)') THEN 'Budapest' END AS city, coalesce(own_district, zip_district) AS district,
    round(2 * 6371.0 * asin(sqrt(power(sin((radians(lat) - radians({_HOME.lat}::DOUBLE)) / 2), 2) + cos(radians({_HOME.lat}::DOUBLE)) * cos(radians(lat)) * power(sin((radians(lon) - radians({_HOME.lon}::DOUBLE)) / 2), 2))), 2) AS distance_km,
    CASE WHEN is_free THEN 0 ELSE list_min(amounts) END AS price_min,
    CASE WHEN NOT is_free AND len(amounts) > 1 THEN list_max(amounts) END AS price_max, is_free,
    coalesce("end" - "start" >= INTERVAL 8 DAY, false) AS is_series,
    CASE WHEN "start" IS NULL THEN 'unparseable_start'
      WHEN CASE WHEN "end" IS NULL AND known0 THEN "start" < TIMESTAMP '{NOW}' ELSE CAST(coalesce("end", "start") AS DATE) < DATE '{NOW[:10]}' END THEN 'dropped_past'
      WHEN CASE WHEN known0 THEN "start" > TIMESTAMP '{NOW}' + INTERVAL 14 DAY ELSE CAST("start" AS DATE) > DATE '{NOW[:10]}' + 14 END THEN 'beyond_horizon' END AS drop_reason
  FROM parsed),
listing AS (SELECT * EXCLUDE (drop_reason) FROM listing_all WHERE drop_reason IS NULL)"""


def oracle(select: str, *more: str) -> str:
    """DuckDB SQL over ``raw``, ``listing_all``, ``listing`` and further CTEs."""
    return f"WITH {', '.join([raw_sql(False), LISTING, *more])} {select}"


def rated(pairs: str, name: str, floor: float) -> str:
    """DuckDB: CTEs up to ``name`` (a, b, ratio), the token-set ratio of the text
    pairs (a, b) of ``pairs`` that may reach the floor."""
    tokens = "list_sort(list_distinct(list_filter(string_split_regex({}, '\\s+'), lambda w: w <> '')))".format
    join = "array_to_string(list_filter({}, lambda w: {}list_contains({}, w)), ' ')".format
    best = "CASE WHEN len(p) = 0 OR len(q) = 0 THEN 0 WHEN s > 0 AND (x = '' OR y = '') THEN 100 WHEN s = 0 THEN {0} ELSE greatest({0}, 100 - 100.0::DOUBLE * (length(x) + 1) / (s + ab), 100 - 100.0::DOUBLE * (length(y) + 1) / (s + ba)) END".format
    lcs = "list_last(list_reduce([list_transform(range(0, length(y) + 1), lambda z: 0::BIGINT)] || list_transform(string_split(x, ''), lambda c: [unicode(c)::BIGINT]), lambda r, c: list_reduce([[0::BIGINT]] || list_transform(range(1, length(y) + 1), lambda j: [j]), lambda o, j: o || [CASE WHEN ys[j[1]] = c[1] THEN r[j[1]] + 1 ELSE greatest(r[j[1] + 1], o[len(o)]) END])))"
    return f"""
{name}_sets AS (SELECT a, b, {tokens('a')} AS p, {tokens('b')} AS q FROM {pairs}),
{name}_parts AS (SELECT *, s + g + length(x) AS ab, s + g + length(y) AS ba FROM (SELECT *, length(i) AS s, (i <> '')::INT AS g FROM (
  SELECT *, {join('p', '', 'q')} AS i, {join('p', 'NOT ', 'q')} AS x, {join('q', 'NOT ', 'p')} AS y FROM {name}_sets))),
{name}_near AS MATERIALIZED (SELECT *, list_transform(string_split(y, ''), lambda c: unicode(c)::BIGINT) AS ys FROM {name}_parts WHERE {best('100 - 100.0::DOUBLE * levenshtein(x, y) / (ab + ba)')} >= {floor} - 0.000001),
{name} AS MATERIALIZED (SELECT a, b, {best('100 - 100.0::DOUBLE * (length(x) + length(y) - 2 * lcs) / (ab + ba)')} AS ratio FROM (SELECT *, CASE WHEN x <> '' AND y <> '' THEN {lcs} ELSE 0 END AS lcs FROM {name}_near))"""
