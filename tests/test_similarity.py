"""Token-set similarity: the Column, the plain form and the join."""

import random

from listweave.functions import similarity


def texts(seed, n):
    rng = random.Random(seed)
    words = ["koncert", "koncertek", "jazz", "jaz", "a38", "esti", "est", "klub", "klubest", "ab", "abc", "b"]
    return sorted({" ".join(rng.choices(words, k=rng.randint(0, 4))) + rng.choice(["", "", "x", " q"]) for _ in range(n)})


def test_golden_ratios():
    assert similarity.ratio("kobuci kert", "kopaszi kert") < 70.5
    assert similarity.ratio("red black", "red black tarsasjatekszalon") == 100
    assert similarity.ratio("", "a") == 0 == similarity.ratio("", "")


def test_column_equals_plain_form(spark):
    some = texts(1, 60)
    pairs = [(a, b) for a in some for b in some] + [(None, "a"), ("a", None)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.token_set_ratio("a", "b").alias("r")).collect()
    for r in rows:
        want = None if r.a is None or r.b is None else similarity.ratio(r.a, r.b)
        assert (r.r is None) == (want is None) and (want is None or abs(r.r - want) < 1e-9), r


def test_join_finds_every_pair(spark):
    left, right = texts(2, 150), texts(3, 150)
    frames = [spark.createDataFrame([(d, t) for t in side for d in (1, 2) if len(t) % 2 or d == 1] + [(1, None)], "d int, text string") for side in (left, right)]
    for threshold in (80.0, 85.0, 92.0):
        found = {(r.d, r.a, r.b) for r in similarity.similar(*frames, threshold, ["d"]).collect()}
        on = lambda side, d: [t for t in side if len(t) % 2 or d == 1]
        assert found == {(d, a, b) for d in (1, 2) for a in on(left, d) for b in on(right, d) if similarity.ratio(a, b) >= threshold}


def test_no_bound_is_worked_out_at_every_meeting(spark):
    """Texts that share several words meet on each of them; the costly bound reads
    a table of distinct pairs."""
    pairs = spark.createDataFrame([("a b", "a c")] * 5, "ka string, kb string")
    once = similarity._once(pairs)
    plan = similarity.rated(once, 80.0)._jdf.queryExecution().optimizedPlan().toString()
    assert once.count() == 1 and "Aggregate" not in plan and "Join" not in plan


def test_the_bounds_lose_no_pair(spark):
    """Every pair that reaches the threshold passes the bounds by bits at a key it
    shares, also where a key is dealt out in parts and whichever way texts recur."""
    left, right = texts(5, 200), texts(6, 200)
    frame = lambda side: spark.createDataFrame([(t,) for t in side], "text string").select(similarity.canonical("text").alias("key")).filter("key <> ''").distinct()
    keep, similarity.HEAVY = similarity.HEAVY, 8
    try:
        for threshold in (80.0, 92.0):
            found = {tuple(r) for r in similarity._candidates(frame(left), frame(right), threshold, []).collect()}
            keys = lambda side: {" ".join(sorted(set(t.split()))) for t in side} - {""}
            assert {(a, b) for a in keys(left) for b in keys(right) if similarity.ratio(a, b) >= threshold} <= found
    finally:
        similarity.HEAVY = keep


def test_grouping_follows_the_cost(spark):
    few = spark.createDataFrame([(d, f"t{k}") for d in range(9) for k in range(5)], "d int, key string")
    many = spark.createDataFrame([(d, f"t{d}x{k}") for d in range(9) for k in range(5)], "d int, key string")
    assert similarity._grouped(few, few, ["d"]) == [] and similarity._grouped(many, many, ["d"]) == ["d"]


def test_one_match_is_enough(spark):
    """The texts with any match are those of the whole join, and texts that hold one
    of the other side, less up to two words, are settled without being compared."""
    left, right = texts(7, 150), texts(8, 60)
    frames = [spark.createDataFrame([(d, t) for t in side for d in (1, 2) if len(t) % 2 or d == 1] + [(1, None)], "d int, text string") for side in (left, right)]
    for threshold in (80.0, 92.0):
        want = {(r.d, r.a) for r in similarity.similar(*frames, threshold, ["d"]).collect()}
        rows = similarity.with_similar(*frames, threshold, ["d"]).collect()
        assert len(rows) == len(want) and {(r.d, r.a) for r in rows} == want
    compared, whole = [], similarity.similar
    try:
        similarity.similar = lambda a, b, *rest: compared.extend(r.text for r in a.collect()) or whole(a, b, *rest)
        some = spark.createDataFrame([("a b c d | e",), ("b a",), ("a c b",), ("q",)], "text string")
        found = similarity.with_similar(some, spark.createDataFrame([("d c b a",), ("a b",)], "text string"), 92.0).collect()
    finally:
        similarity.similar = whole
    assert {r.a for r in found} == {"a b c d | e", "b a", "a c b"} and compared == ["q"]
