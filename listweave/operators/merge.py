"""Duplicate listings: clusters by id, by URL or by similar titles, and their merge."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listweave.config import MAX_START_GAP_MINUTES, TITLE_AMBIGUOUS_RATIO, TITLE_MERGE_RATIO, UNKNOWN_SOURCE_PRIORITY, VENUE_MATCH_RATIO, Settings
from listweave.functions import similarity, text
from listweave.tables import drop_stash, stash, streamed


def clusters(edges: DataFrame) -> DataFrame:
    """(node, cluster) of the ends of ``edges`` (a, b): the least node reachable.
    Every round takes the least label among neighbours and then that label's own
    label, until nothing changes; labels only fall."""
    both = stash(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stash(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"], "left").select("node", "label", F.least("label", "near").alias("next"))
        lower = stash(lower, "lower")
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("far"))
        after = stash(lower.join(jump, "next").select("node", F.least("next", "far").alias("label"), F.col("label").alias("was")), "labels")
        changed = after.filter("label <> was").limit(1).count()
        drop_stash(labels, lower)
        labels = after
        if not changed:
            drop_stash(both)
            return labels.select("node", F.col("label").alias("cluster"))


def url_clusters(listings: DataFrame) -> DataFrame:
    """(ord, cluster) of ``listed`` rows: in order, each joins the cluster that one
    of its normalized URLs stands for, its first such URL deciding, and from then
    on all URLs of that cluster stand for it. Rows with one URL each, by far the
    most, need only the first row of that URL; rows that several URLs connect are
    taken through one task per connection, in their order, as a stream."""
    keyed = listings.select("ord", F.posexplode(F.transform("urls", text.normalize_url)).alias("at", "url"))
    keyed = stash(keyed.groupBy("ord", "url").agg(F.min("at").alias("at")), "keyed")
    first = stash(keyed.groupBy("url").agg(F.min("ord").alias("b"), F.count("*").alias("n")).filter("n > 1"), "urls")
    linked = clusters(keyed.join(first, "url").select(F.col("ord").alias("a"), "b"))
    several = keyed.groupBy("ord").agg(F.count("*").alias("n")).filter("n > 1").select("ord")
    of = linked.select(F.col("node").alias("ord"), "cluster")
    tangled = of.join(several, "ord").select("cluster").distinct()
    rows = keyed.join(of, "ord").join(tangled, "cluster", "left_semi").groupBy("cluster", "ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "url"))), lambda x: x["url"]).alias("urls"))
    replayed = streamed(rows.repartition("cluster").sortWithinPartitions("cluster", "ord"), _first_urls, "of bigint, joined bigint")
    out = listings.select("ord").join(of, "ord", "left").join(replayed, F.col("ord") == F.col("of"), "left")
    return out.select("ord", F.coalesce("joined", "cluster", "ord").alias("cluster"))


def _first_urls(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(ord, cluster) of rows (component, ord, urls) sorted by both."""
    for _, those in groupby(rows, itemgetter(0)):
        stands_for, urls_of = {}, {}
        for _, ord_, urls in those:
            root = next((stands_for[u] for u in urls if u in stands_for), ord_)
            urls_of.setdefault(root, set()).update(urls)
            stands_for.update(dict.fromkeys(urls_of[root], root))
            yield ord_, root


def priority(settings: Settings, source: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in settings.source_priorities.items() for x in pair])
    return F.coalesce(F.try_element_at(known, source), F.lit(UNKNOWN_SOURCE_PRIORITY))


#: What a merge does with a listing's columns: `base` keeps the base record's,
#: `fill` takes the first there is, `longest` the longest; `a+b` move together.
RULES = {
    "id": "base", "title": "base", "start": "base", "start_time_known": "base", "effective_date": "base",
    "description": "longest",
    "end": "fill", "venue_name": "fill", "city": "fill", "district": "fill", "image_url": "fill", "is_series": "fill",
    "price_min+price_max+is_free": "fill", "lat+lon+distance_km": "fill",
}


#: Lists that a merge unites: the base's values, then the other's, each once.
UNITED = ("source_ids", "urls", "native_categories")


def listed(rows: DataFrame) -> DataFrame:
    """Normalized listings with the lists that merging unites."""
    one = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.array(c)).otherwise(F.array().cast("array<string>"))
    return rows.withColumns({"source_ids": F.array("source_id"), "urls": F.array("url"), "native_categories": one("native_category")}).drop("source_id", "url", "url_norm", "native_category")


def merged(rows: DataFrame, settings: Settings, cluster: str = "cluster") -> DataFrame:
    """One row per cluster of ``listed`` rows. The fold over a cluster's records in
    order has an aggregate form: a record leads if its best source's priority is
    strictly below every earlier one's; the base is the last leading record, a
    value is the last leading one there is or else the first, so no cluster is
    ever collected. A united list holds the values of the leading records from the
    last on, then those of the others from the first on; of a value only its best
    place is kept before the list is made."""
    before = Window.partitionBy(cluster).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_p", F.array_min(F.transform("source_ids", lambda s: priority(settings, s))))
    ranked = ranked.withColumn("_leads", F.coalesce(F.col("_p") < F.min("_p").over(before), F.lit(True)))
    # larger is preferred: leading records by their order, then the others from the first on
    rank = F.struct(F.col("_leads").cast("int"), F.when(F.col("_leads"), F.col("ord")).otherwise(-F.col("ord")))
    ranked = stash(ranked.withColumn("_rank", rank), "ranked")
    rank = F.col("_rank")
    aggregates = []
    for names, rule in RULES.items():
        first, *others = names.split("+")
        if first not in rows.columns:
            continue
        order = rank
        if rule == "fill":
            order = F.struct(F.col(first).isNotNull().alias("there"), rank)
        if rule == "longest":
            order = F.struct(F.coalesce(F.length(first), F.lit(-1)).alias("size"), rank)
        aggregates += [F.max_by(n, order).alias(n) for n in (first, *others)]
    out = ranked.groupBy(cluster).agg(F.min("ord").alias("ord"), F.count("*").alias("records"), *aggregates)
    values = ranked.select(cluster, "_rank", F.explode(F.array(*[F.struct(F.lit(n).alias("list"), F.col(n).alias("of")) for n in UNITED])).alias("l"))
    values = values.select(cluster, "_rank", "l.list", F.posexplode("l.of").alias("at", "value"))
    best = values.groupBy(cluster, "list", "value").agg(F.max(F.struct("_rank", -F.col("at"))).alias("place"))
    lists = best.groupBy(cluster, "list").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "value")), asc=False), lambda x: x["value"]).alias("values"))
    wide = lists.groupBy(cluster).agg(*[F.max(F.when(F.col("list") == n, F.col("values"))).alias(n) for n in UNITED])
    none = F.array().cast("array<string>")
    return out.join(wide, cluster).withColumns({n: F.coalesce(n, none) for n in UNITED})


# --- similar listings -------------------------------------------------------

#: Seconds of a bin of the start gate: the widest gap it lets pass.
_BIN = MAX_START_GAP_MINUTES * 60


def fuzzy_titles(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fuzzy``, the title compared when looking for similar
    listings: without its last segment if that names the venue. ``plain`` and
    ``headed`` are the normalized titles with and without the segment."""
    head, tail = text.separated_tail("title")
    venue = text.normalize_venue("venue_name")
    named = rows.withColumns({"plain": text.normalize_title("title"), "headed": text.normalize_title(head), "tail": text.normalize_venue(tail), "venue": venue})
    names = (F.col("venue") != "") & F.col("headed").isNotNull()
    same = F.when(names, similarity.token_set_ratio(F.when(names, F.col("tail")), F.when(names, F.col("venue"))) >= VENUE_MATCH_RATIO)
    return named.withColumn("fuzzy", F.when(F.coalesce(same, F.lit(False)), F.col("headed")).otherwise(F.col("plain")))


def strip_venue_suffix(title: str, venue: str) -> Column:
    """The title without its last segment if that names the venue."""
    head, tail = text.separated_tail(title)
    place = text.normalize_venue(venue)
    names = (place != "") & head.isNotNull()
    ratio = similarity.token_set_ratio(F.when(names, text.normalize_venue(tail)), F.when(names, place))
    return F.when(F.coalesce(ratio >= VENUE_MATCH_RATIO, F.lit(False)), head).otherwise(F.col(title))


def timed(rows: DataFrame) -> DataFrame:
    """``rows`` with a start: its ``second`` and ``day``, whether the clock is ``known``,
    and the keys on which two listings within the start gate meet. ``at`` are the keys
    of the earlier one in input order, ``to`` those of the other. Clocks meet in bins as
    wide as the gap, the earlier one in its own and both neighbours; a listing without a
    clock meets the other's day, and two clocks never meet by day."""
    out = rows.filter("start IS NOT NULL").withColumns({
        "second": F.unix_seconds(F.col("start").cast("timestamp")),
        "known": F.coalesce("start_time_known", F.lit(False)),
        "day": F.col("start").cast("date").cast("string"),
    })
    bin_ = F.floor(F.col("second") / _BIN)
    key = lambda kind, value: F.concat(F.lit(kind), value.cast("string"))
    at = F.when(F.col("known"), F.array(*[key("k", bin_ + k) for k in (-1, 0, 1)], key("v", F.col("day")))).otherwise(F.array(key("u", F.col("day"))))
    to = F.when(F.col("known"), F.array(key("k", bin_), key("u", F.col("day")))).otherwise(F.array(key("u", F.col("day")), key("v", F.col("day"))))
    return out.withColumns({"at": at, "to": to})


def comparable(rows: DataFrame) -> DataFrame:
    """(ord, second, known, day, venue, titles..., at, to) of ``timed`` listings, as a
    table: what the gates and the title ratio read."""
    return stash(timed(fuzzy_titles(rows)).select(
        "ord", "second", "known", "day", "venue_name", text.venue_tokens("venue_name").alias("tokens"), "plain", "headed", "tail", "venue", "fuzzy", "at", "to",
    ), "comparable")


def _sides(rows: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    side = lambda keys, n: rows.select(F.explode(keys).alias("meet"), *[F.col(c).alias(f"{c}_{n}") for c in ("ord", "second", "known", *columns)])
    return side("at", "a"), side("to", "b")


def _gated(pairs: DataFrame) -> DataFrame:
    near = F.abs(F.col("second_a") - F.col("second_b")) <= _BIN
    return pairs.filter((F.col("ord_a") < F.col("ord_b")) & F.when(F.col("known_a") & F.col("known_b"), near).otherwise(F.lit(True)))


def start_pairs(rows: DataFrame, on: str | None = None) -> DataFrame:
    """(a, b), a before b, of all listings within the start gate: both clocks
    known and at most 90 minutes apart, or else the same day. ``on`` names a
    column in which they agree besides. Of the listings only the times and that
    column are read, and neither side is sent whole to every task: its files may be
    small where its rows are many."""
    a, b = _sides(timed(rows), *([on] if on else []))
    keys = {"meet": "meet"} | ({f"{on}_a": f"{on}_b"} if on else {})
    b = b.withColumnsRenamed({theirs: ours for ours, theirs in keys.items()})
    met = _by_meetings(a, *keys).join(b.hint("merge"), list(keys))
    return _gated(met).select(F.col("ord_a").alias("a"), F.col("ord_b").alias("b"))


def spelled(table: DataFrame, forms: bool) -> DataFrame:
    """(spelling, fuzzy, plain, headed), one row per distinct spelling of a title
    in ``comparable`` rows; without ``forms`` the fuzzy title alone tells them apart."""
    columns = ["fuzzy", "plain", "headed"] if forms else ["fuzzy"]
    return stash(table.filter("fuzzy IS NOT NULL").select(*columns).distinct().withColumn("spelling", F.monotonically_increasing_id()), "spellings")


def alike_spellings(spellings: DataFrame, floor: float, forms: bool) -> DataFrame:
    """(spelling_a, spelling_b, ratio, reach) of the ``spelled`` titles that come to
    ``floor``; each pair of distinct titles is rated once, however many listings
    bear them."""
    any_form = F.explode(F.array_distinct(F.filter(F.array("plain", "headed"), lambda t: t.isNotNull()))) if forms else F.col("fuzzy")
    of = spellings.select("spelling", "fuzzy", any_form.alias("text"))
    near = similarity.similar(of.select("text"), of.select("text"), floor).select(F.col("a").alias("text_a"), F.col("b").alias("text_b"), "ratio")
    side = lambda n: of.select(*[F.col(c).alias(f"{c}_{n}") for c in of.columns])
    met = side("a").join(near, "text_a").join(side("b"), "text_b")
    own = F.when((F.col("text_a") == F.col("fuzzy_a")) & (F.col("text_b") == F.col("fuzzy_b")), F.col("ratio"))
    pairs = met.groupBy("spelling_a", "spelling_b").agg(F.max(own).alias("ratio"), F.max("ratio").alias("reach"))
    return stash(pairs, "alike")


def _by_meetings(rows: DataFrame, *keys: str) -> DataFrame:
    """Over all partitions: what meets on the keys is much more than their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def fuzzy_pairs(table: DataFrame, floor: float = TITLE_AMBIGUOUS_RATIO, forms: bool = True) -> DataFrame:
    """(a, b, ratio, reach), a before b, of the rows of ``comparable`` that pass
    the start and the venue gate and whose titles come to ``floor``. ``ratio`` is
    that of the fuzzy titles (null below the floor), ``reach`` the best of any of
    their forms: a venue that a merge fills in can only choose among them. Without
    ``forms`` only the fuzzy titles are compared.

    Similar venues and similar titles are found among the distinct ones. Two
    listings with venues meet by similar venue and time, and a look-up of their two
    spellings settles the pair; where a venue is missing they meet by time and
    similar spelling. Two listings meet on one key at most, so no pair is made
    twice, and no text is carried along. No key gathers a day or all listings
    without a venue."""
    places = table.filter("tokens <> '' AND venue_name IS NOT NULL").select(F.col("tokens").alias("text")).distinct()
    venues = stash(similarity.similar(places, places, VENUE_MATCH_RATIO), "venues").select(F.col("a").alias("tokens_a"), F.col("b").alias("tokens_b"))
    spellings = spelled(table, forms)
    alike = alike_spellings(spellings, floor, forms)
    named = reduce(lambda x, y: x & y, [table[c].eqNullSafe(spellings[c]) for c in spellings.columns if c != "spelling"])
    rows = stash(table.join(spellings, named).select(*[table[c] for c in ("ord", "second", "known", "at", "to", "tokens", "venue_name")], "spelling"), "placed")

    found = ["ord_a", "ord_b", "ratio", "reach"]
    a, b = _sides(rows.filter("venue_name IS NOT NULL"), "tokens", "spelling")
    placed = _gated(_by_meetings(a.join(venues, "tokens_a"), "meet", "tokens_b").join(b, ["meet", "tokens_b"])).select("ord_a", "ord_b", "spelling_a", "spelling_b")
    pairs = placed.join(alike, ["spelling_a", "spelling_b"]).select(*found)

    a, b = _sides(rows, "venue_name", "spelling")
    for left, right in ((a.filter("venue_name_a IS NULL"), b), (a.filter("venue_name_a IS NOT NULL"), b.filter("venue_name_b IS NULL"))):
        pairs = pairs.unionByName(_gated(_by_meetings(left.join(alike, "spelling_a"), "meet", "spelling_b").join(right, ["meet", "spelling_b"])).select(*found))
    return pairs.withColumnsRenamed({"ord_a": "a", "ord_b": "b"})


def _first_matches(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(ord, cluster) of rows sorted by component and order: each joins the first
    cluster, by its first member, that it matches as merged so far, or opens one.
    A cluster is compared as its base's title and start and the venue it has by
    now; only clusters whose base is a neighbour can match."""
    for _, those in groupby(rows, itemgetter(0)):
        cluster_of, state = {}, {}
        for _, ord_, near, priority, second, known, day, venue_name, tokens, plain, headed, tail, venue in those:
            mine = (priority, ord_, second, known, day, venue_name, tokens, plain, headed, tail, venue)
            roots = sorted({cluster_of[n] for n in near if state[cluster_of[n]][1] == n})
            root = next((r for r in roots if _matches(state[r], mine)), None)
            if root is None:
                cluster_of[ord_], state[ord_] = ord_, mine
            else:
                base, other = (mine, state[root]) if priority < state[root][0] else (state[root], mine)
                if base[5] is None:
                    base = (*base[:5], other[5], other[6], *base[7:10], other[10])
                cluster_of[ord_], state[root] = root, base
            yield ord_, cluster_of[ord_]


def _matches(a: tuple, b: tuple) -> bool:
    near = abs(a[2] - b[2]) <= _BIN if a[3] and b[3] else a[4] == b[4]
    place = a[5] is None or b[5] is None or similarity.ratio(a[6], b[6]) >= VENUE_MATCH_RATIO
    return near and place and similarity.ratio(_title(a), _title(b)) >= TITLE_MERGE_RATIO


def _title(row: tuple) -> str:
    *_, plain, headed, tail, venue = row
    return headed if venue and headed is not None and similarity.ratio(tail, venue) >= VENUE_MATCH_RATIO else plain


def fuzzy_clusters(rows: DataFrame, settings: Settings) -> DataFrame:
    """(ord, cluster) of listings (with ``source_ids``): in order, each merges into
    the first earlier cluster it matches, which may then match others. That is a
    fold, so connected listings are taken through one task in their order, as a
    stream with their neighbours; components share nothing and run apart."""
    table = comparable(rows)
    edges = stash(fuzzy_pairs(table, TITLE_MERGE_RATIO).select("a", "b"), "similar")
    of = clusters(edges)
    near = edges.groupBy(F.col("b").alias("ord")).agg(F.collect_list("a").alias("near"))
    least = rows.select("ord", F.array_min(F.transform("source_ids", lambda s: priority(settings, s))).alias("priority"))
    members = table.join(of.withColumnRenamed("node", "ord"), "ord").join(near, "ord", "left").join(least, "ord")
    ordered = members.select(
        "cluster", "ord", F.coalesce("near", F.array().cast("array<bigint>")).alias("near"), "priority", "second", "known", "day", "venue_name", "tokens", "plain", "headed", "tail", "venue",
    ).repartition("cluster").sortWithinPartitions("cluster", "ord")
    joined = streamed(ordered, _first_matches, "of bigint, cluster bigint")
    return rows.select("ord").join(joined, F.col("ord") == F.col("of"), "left").select("ord", F.coalesce("cluster", "ord").alias("cluster"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """Numbers of pairs of listings of different sources: all, on the same day,
    within the start gap. No pair is made: rows are counted by source and by day,
    and for the gap by second, where a frame over the seconds before sums them up.
    Frames run within bins of one gap, each with the bin before it, so no window
    holds more than two bins of seconds."""
    second = F.unix_seconds(F.col("start").cast("timestamp"))
    slots = stash(rows.groupBy("source_id", second.alias("second")).agg(F.count("*").alias("n")), "slots")
    slots = slots.withColumn("day", F.floor(F.col("second") / 86400))
    half = lambda total, own: ((F.coalesce(F.sum(total), F.lit(0)) - F.coalesce(F.sum(own), F.lit(0))) / 2).cast("bigint")

    def unlike(keys: list[str]) -> DataFrame:
        """Ordered pairs of different sources with equal keys."""
        by = slots.groupBy(*keys, "source_id").agg(F.sum("n").alias("n"))
        return by.groupBy(*keys).agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("own")).agg(half(F.col("all") * F.col("all"), F.col("own")))

    # later rows of a pair look back: their own bin of one gap, and the one before
    bin_ = F.floor(F.col("second") / _BIN)
    twice = slots.withColumn("at", F.explode(F.array(bin_, bin_ + 1))).withColumn("asks", F.col("at") == bin_)

    def within(partition: list[str]) -> DataFrame:
        """Rows at most a gap earlier, plus half of those of the same second."""
        per = twice.groupBy(*partition, "at", "second", "asks").agg(F.sum("n").alias("n"))
        back = Window.partitionBy(*partition, "at").orderBy("second").rangeBetween(-_BIN, -1)
        met = per.withColumn("met", F.coalesce(F.sum("n").over(back), F.lit(0))).filter("asks")
        return met.agg(F.coalesce(F.sum(F.col("n") * F.col("met") * 2 + F.col("n") * F.col("n")), F.lit(0)).alias("n"))

    counts = {"pairs": unlike([]), "same_day": unlike(["day"]), "every": within([]), "own": within(["source_id"])}
    rows = reduce(DataFrame.union, [df.toDF("n").withColumn("count", F.lit(name)) for name, df in counts.items()])
    of = lambda name: F.max(F.when(F.col("count") == name, F.col("n")))
    return rows.agg(of("pairs").alias("pairs"), of("same_day").alias("same_day"), ((of("every") - of("own")) / 2).cast("bigint").alias("within_gap"))
