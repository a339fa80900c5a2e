"""Clusters and merges against the folds they stand for."""

import datetime as dt
import random
import re

import pytest

from listweave.functions import similarity
from listweave.operators import merge
from listweave.tables import stash
from listweave.testview import SETTINGS

SCHEMA = "ord long, cluster long, source_ids array<string>, urls array<string>, native_categories array<string>, id string, title string, start string, start_time_known boolean, effective_date string, description string, `end` string, venue_name string, city string, district string, price_min long, price_max long, is_free boolean, lat double, lon double, distance_km double"
NAMES = [x.split(" ")[0].strip("`") for x in SCHEMA.split(", ")]
UNITED = ("source_ids", "urls", "native_categories")


def best(record):
    return min((SETTINGS.source_priorities.get(s, 1000) for s in record["source_ids"]), default=1000)


def merged(first, second):
    base, other = (second, first) if best(second) < best(first) else (first, second)
    new = dict(base)
    for name in UNITED:
        new[name] = base[name] + [v for v in other[name] if v not in base[name]]
    for name in ("end", "venue_name", "city", "district"):
        new[name] = base[name] if base[name] is not None else other[name]
    for group in (("price_min", "price_max", "is_free"), ("lat", "lon", "distance_km")):
        if base[group[0]] is None:
            new.update({n: other[n] for n in group})
    if len(other["description"] or "") > len(base["description"] or "") or base["description"] is None:
        new["description"] = other["description"]
    return new


def test_merge_equals_the_fold(spark):
    rng = random.Random(4)
    some = lambda *v: rng.choice([None, *v])
    lists = lambda *v: rng.sample(v, rng.randint(0, len(v)))
    rows = []
    for c in range(120):
        for _ in range(rng.randint(1, 6)):
            n = len(rows)
            price, lat = some(1, 2), some(1.0, 2.0)
            rows.append((n, c, rng.sample(["s0", "s1", "s2", "s3"], rng.randint(1, 2)), lists("u1", "u2", "u3"), lists("n1", "n2"), f"i{n}", f"t{n}", f"s{n}", True, "d", some("a", "bb", "cc"), some("e1", "e2"), some("v1", "v2"), some("c"), some("d1", "d2"), price, price, bool(price), lat, lat, lat))
    found = {r.cluster: r.asDict() for r in merge.merged(spark.createDataFrame(rows, SCHEMA), SETTINGS).collect()}
    for c in range(120):
        records = [dict(zip(NAMES, r, strict=True)) for r in rows if r[1] == c]
        want = records[0]
        for r in records[1:]:
            want = merged(want, r)
        for name in (*UNITED, "id", "title", "end", "venue_name", "city", "district", "price_min", "is_free", "lat", "description"):
            assert found[c][name] == want[name], (c, name)
        assert found[c]["records"] == len(records)


def test_clusters(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (3, 10)], "a long, b long")
    assert {r.node: r.cluster for r in merge.clusters(edges).collect()} == {1: 1, 2: 1, 3: 1, 10: 1, 7: 7, 8: 7, 9: 7}


def test_url_clusters_in_order(spark):
    """A row joins the first cluster of its URLs; clusters it bridges stay apart."""
    rng = random.Random(7)
    rows = [(n, [f"http://X.hu/{rng.randint(0, 400)}{rng.choice(['', '/', '?q'])}" for _ in range(rng.choice([1, 1, 1, 2, 3]))]) for n in range(600)] + [(n, []) for n in (600, 601)]
    found = {r.ord: r.cluster for r in merge.url_clusters(spark.createDataFrame(rows, "ord long, urls array<string>")).collect()}
    stands_for, urls_of = {}, {}
    for ord_, urls in rows:
        keys = [re.sub(r"(\?.*|/+)$", "", u).lower() for u in urls]
        root = next((stands_for[k] for k in keys if k in stands_for), ord_)
        urls_of.setdefault(root, []).extend(keys)
        for k in urls_of[root]:
            stands_for[k] = root
        assert found[ord_] == root, (ord_, urls)


LISTING = "ord long, title string, venue_name string, start timestamp_ntz, start_time_known boolean, source_ids array<string>"


def listings():
    """Similar titles with and without venue suffix, missing venues and clocks."""
    rng = random.Random(3)
    rows = [(0, "Jazz est", None, dt.datetime(2024, 1, 1, 19), True, ["s2"]), (1, "Jazz est", "Akvarium Klub", dt.datetime(2024, 1, 1, 19, 30), True, ["s1"]), (2, "Jazz est", "Kobuci kert", dt.datetime(2024, 1, 1, 20), True, ["s0"])]
    for n in range(3, 260):
        title = " ".join(rng.sample(["Jazz", "est", "koncert", "Nagy", "Réka", "trio", "kvartett"], rng.randint(1, 4)))
        venue = rng.choice([None, "Akvárium Klub", "Akvarium", "Kobuci Kert", "A38", "A-38 hajó"])
        title += rng.choice(["", "", " (HU)", f" | {venue}", " - Budapest", " - A38"])
        known = rng.random() < 0.8
        start = dt.datetime(2024, 1, rng.randint(1, 5), rng.randint(17, 22) if known else 0, rng.choice([0, 30, 31]) if known else 0)
        rows.append((n, title, venue, start, known, [rng.choice(["s0", "s1", "s2", "s3"])]))
    return rows


def fold(text):
    import unicodedata

    return " ".join("".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower().split())


def normal(title):
    return re.sub(r"(\s*\(\s*([^()\s]+(\s+[^()\s]+)?\s*)?\)\s*)+$", "", fold(title)).strip()


def fuzzy_title(title, venue):
    marks = list(re.finditer(r"\s+[|-]\s+", title))
    if venue and marks and similarity.ratio(fold(title[marks[-1].end() :]), fold(venue)) >= 85:
        return normal(title[: marks[-1].start()])
    return normal(title)


def score(a, b):
    """Ratio of two (title, venue, start, known) that pass both gates, else None."""
    if abs(a[2] - b[2]) > dt.timedelta(minutes=90) if a[3] and b[3] else a[2].date() != b[2].date():
        return None
    tokens = lambda v: re.sub("[^0-9a-z]+", " ", fold(v)).strip()
    if a[1] is not None and b[1] is not None and similarity.ratio(tokens(a[1]), tokens(b[1])) < 85:
        return None
    return similarity.ratio(fuzzy_title(*a[:2]), fuzzy_title(*b[:2]))


@pytest.fixture(scope="module")
def similar_rows(spark):
    return spark.createDataFrame(listings(), LISTING)


def test_fuzzy_pairs_equal_brute_force(spark, similar_rows):
    rows = [r[1:5] for r in listings()]
    want = {(i, j): score(rows[i], rows[j]) for j in range(len(rows)) for i in range(j)}
    want = {k: v for k, v in want.items() if v is not None and v >= 80}
    found = {(r.a, r.b): r.ratio for r in merge.fuzzy_pairs(merge.comparable(similar_rows)).collect() if r.ratio is not None}
    assert found.keys() == want.keys()
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_fuzzy_clusters_equal_the_greedy_fold(spark, similar_rows):
    found = {r.ord: r.cluster for r in merge.fuzzy_clusters(similar_rows, SETTINGS).collect()}
    state = []  # (root, priority, (title, venue, start, known))
    for ord_, *row, sources in listings():
        mine = (SETTINGS.source_priorities.get(sources[0], 1000), tuple(row))
        at = next((k for k, (_, _, other) in enumerate(state) if (score(other, mine[1]) or 0) >= 88), None)
        if at is None:
            state.append((ord_, *mine))
            root = ord_
        else:
            root, priority, other = state[at]
            base, rest = (mine[1], other) if mine[0] < priority else (other, mine[1])
            state[at] = (root, min(priority, mine[0]), (base[0], base[1] if base[1] is not None else rest[1], *base[2:]))
        assert found[ord_] == root, (ord_, row)
    assert 50 < len(state) < 240


def test_start_pairs_equal_brute_force(spark, similar_rows):
    rows = [r[1:5] for r in listings()]
    same = lambda a, b: abs(a[2] - b[2]) <= dt.timedelta(minutes=90) if a[3] and b[3] else a[2].date() == b[2].date()
    want = {(i, j) for j in range(len(rows)) for i in range(j) if same(rows[i], rows[j])}
    found = [(r.a, r.b) for r in merge.start_pairs(similar_rows).collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_the_start_gate_sends_no_side_to_every_task(similar_rows, spark):
    """Whatever the sizes of the files: the rows behind them may fill a driver."""
    table = stash(similar_rows.select("ord", "venue_name", "start", "start_time_known"), "few")
    pairs = merge.start_pairs(table, "venue_name")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "title" not in plan
    venue = {r.ord: r.venue_name for r in similar_rows.collect()}
    want = [(r.a, r.b) for r in merge.start_pairs(similar_rows).collect() if venue[r.a] is not None and venue[r.a] == venue[r.b]]
    assert sorted((r.a, r.b) for r in pairs.collect()) == sorted(want) and want


def test_titles_are_rated_once_however_many_listings_bear_them(spark, similar_rows):
    """Pairs of listings look their ratio up by spelling: as many are rated as there
    are distinct titles, and no pair of listings comes twice."""
    n = 60
    many = [(k, ["Jazz est", "Jazz estek", "Nagy Réka trio"][k % 3], "A38", dt.datetime(2024, 1, 1, 19, k % 30), True, ["s0"]) for k in range(n)]
    table = merge.comparable(spark.createDataFrame(many, LISTING))
    spellings = merge.spelled(table, forms=False)
    assert spellings.count() == 3 and merge.alike_spellings(spellings, 80.0, forms=False).count() <= 9
    found = [(r.a, r.b) for r in merge.fuzzy_pairs(table, forms=False).collect()]
    want = {(i, j) for j in range(n) for i in range(j) if similarity.ratio(normal(many[i][1]), normal(many[j][1])) >= 80}
    assert len(found) == len(set(found)) and set(found) == want
    table = merge.comparable(similar_rows)
    of = lambda forms: {(r.a, r.b): r.ratio for r in merge.fuzzy_pairs(table, forms=forms).filter("ratio IS NOT NULL").collect()}
    assert of(False) == of(True)
