"""Each operator on odd rows, on an empty table, and against brute force."""

import hashlib
import random
import re
import string

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listweave.llm import bpe, langid, licenses, merkle, minhash, packing, passages, suffixes, toxicity, vectors

from .conftest import ODD, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_equals_the_library(odd, none):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    rows = bpe.digests(odd, PATH).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digests(none, PATH).count() == 0


def test_bpe_words_of_random_bytes():
    t, mine = Tokenizer.from_file(PATH), bpe.Bpe(PATH)
    rng = random.Random(3)
    texts = ["".join(rng.choices("aeiou thsné'0 \n.,—", k=rng.randint(0, 60))) for _ in range(800)]
    assert mine.encode(texts) == [",".join(map(str, t.encode(x, add_special_tokens=False).ids)) for x in texts]
    assert mine.exact_words > 0 and len(mine.good) > 0


def test_toxicity(spark, odd, none, labels):
    model = toxicity.learn(odd, labels, F.lit(True))
    rows = toxicity.scored(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(none, model).count() == 0
    assert toxicity.learn(none, labels, F.lit(True)).scores(["idiot"]).tolist() == [0.0]
    assert set(toxicity.reject_toxic(none, labels).columns) == set(none.columns)


def test_toxicity_sees_misspelt_slurs():
    """Held out: texts whose slurs have endings that training never saw."""
    vocabulary = prose(77, 400).split()
    say = lambda seed, n: " ".join(random.Random(seed).choices(vocabulary, k=n))
    slur = lambda seed, k: f"{say(seed, 12)} {('blorgface', 'snorkhead', 'grumble')[k % 3]}{k} {say(seed + 1, 12)} {say(seed + 2, 20)}"
    clean, toxic = [say(k, 45) for k in range(600)], [slur(10_000 + 5 * k, k % 9) for k in range(300)]
    model = toxicity.fit(clean + toxic, [0] * 600 + [1] * 300)
    bad, good = model.scores([slur(50_000 + 5 * k, 100 + k) for k in range(60)]), model.scores([say(90_000 + k, 45) for k in range(60)])
    assert (bad[:, None] > good[None, :]).mean() > 0.8  # chance: 0.5
    assert (good >= toxicity.REJECT).mean() < 0.05
    assert model.scores([""])[0] < toxicity.REJECT


def test_language(odd, none):
    model = langid.learn(odd, F.lit(True))
    rows = {r.doc_id: r for r in langid.identified(odd, model).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[3].lang_pred == "und" and rows[1].score == 0
    assert rows[5].lang_pred in ("en", "fr")
    assert langid.identified(none, langid.learn(none, F.lit(True))).count() == 0
    assert set(langid.reject_unidentified(odd).columns) == set(odd.columns)


def test_packing_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(20):
        histogram = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(9)}
        lengths = sorted(histogram)
        cost = lambda ends: sum(n * (min(e for e in ends if e >= x) - x) for x, n in histogram.items())
        from itertools import combinations

        best = min(cost([*inner, lengths[-1]]) for k in range(3) for inner in combinations(lengths[:-1], min(k, len(lengths) - 1)))
        assert cost(packing.boundaries(histogram, 3)) == best


def test_packing_keeps_every_word(odd, none):
    rows = packing.packed(odd, max_length=1000, budget=3000).collect()
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in ODD)
    assert sum(r.length for r in rows) == words
    full = [r for r in rows if r.bucket is not None]
    assert all(r.length <= r.bucket for r in full)
    batches = {}
    for r in full:
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) and len(s) * b <= max(3000, b) for (b, _), s in batches.items())
    assert packing.packed(none).count() == 0


def brute_links(docs):
    sets = {}
    for k, text in docs:
        w = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return {k: (len(sets[k]), label[k]) for k in sets}


def test_minhash_equals_brute_force(spark, odd, none):
    docs = []
    for g in range(3):
        base = prose(100 + g, 90).split()
        for k in range(12):
            rng = random.Random(g * 50 + k)
            words = list(base)
            for _ in range(k % 5):
                words[rng.randrange(len(words))] = f"w{rng.randrange(99)}"
            docs.append((len(docs), " ".join(words)))
    docs += [(len(docs) + k, text) for k, text in enumerate([docs[3][1], "a b", "a b", "", None])]
    found = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute_links(docs)
    for r in found:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.keep_one(odd).filter("doc_id = 6").count() == 0


def test_the_stage_links_from_080(spark):
    """Copies with a word changed near the start of every 50 words: 0.81 to 0.84; and pairs below 0.8."""
    docs, gone = [], set()
    for k in range(30):
        words = prose(2000 + k, 160 + k).split()
        for n, i in enumerate(range(20, len(words), 50 if k % 5 else 40)):
            docs.append(words) if not n else None
            words = [*words[:i], f"new{k}x{n}", *words[i + 1 :]]
        docs.append(words)
    rows = [(k, " ".join(words)) for k, words in enumerate(docs)]
    for k in range(0, len(docs), 2):
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in docs[k : k + 2])
        share = len(a & b) / len(a | b)
        gone |= {k + 1} if share >= 0.8 else set()
    assert 10 < len(gone) < 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in minhash.keep_one(df).collect()} == set(range(len(docs))) - gone
    assert minhash.near_duplicates(df).filter("doc_id <> component_id").count() == 0
    assert (minhash.matches(85), minhash.matches(80)) == (16, 14)


def test_passages(spark, odd, none):
    shared = prose(500, 80)
    edited = shared.split()
    edited[20], edited[50] = "changed", "again"
    texts = [prose(501, 100) + " " + shared + " " + prose(502, 50), prose(503, 60) + " " + " ".join(edited) + " " + prose(504, 30), prose(505, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    (row,) = passages.passages(docs).collect()
    assert (row.doc_id, row.src_doc_id, row.first_word, row.end_word) == (1, 0, 60, 140) and row.identity == pytest.approx(78 / 80)
    cut = {r.doc_id: r.text for r in passages.cut_passages(docs).collect()}
    assert cut[0] == texts[0] and cut[2] == texts[2] and cut[1].split() == texts[1].split()[:60] + texts[1].split()[140:]
    assert passages.cut_passages(odd).count() == len(ODD) and passages.cut_passages(none).count() == 0


def test_passages_with_many_edits(spark):
    """Every tenth or seventh word is changed: no 20 words in a row are shared."""
    texts, want = [], {}
    for k in range(40):
        words = prose(3000 + k, 60).split()
        step = (10, 7)[k % 2]
        copy = [f"edit{k}x{i}" if i % step == step - 1 else w for i, w in enumerate(words)]
        texts += [f"{prose(4000 + k, 40)} {' '.join(words)} {prose(5000 + k, 40)}", f"{prose(6000 + k, 30)} {' '.join(copy)} {prose(7000 + k, 30)}"]
        want[2 * k + 1] = (2 * k, 30, 90 - (1 if step == 10 else 5))
    found = {r.doc_id: (r.src_doc_id, r.first_word, r.end_word) for r in passages.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found == want


def test_seeds_are_shuffled_in_few_bytes():
    """Ids of any sign come back, and a seed with its place takes half of three longs in a row."""
    rng = np.random.default_rng(1)
    seed, doc = np.sort(rng.integers(0, 1 << 40, 50_000)), rng.integers(-300, 300, 50_000)
    raw = passages.packed(seed, doc, doc + (1 << 40), np.zeros(50_000, np.int32))
    for got, want in zip(passages.unpacked(raw, 4), (seed, doc, doc + (1 << 40), np.zeros(50_000))):
        assert (got == want).all()
    assert len(passages.packed(seed, doc, rng.integers(0, 20_000, 50_000))) < 9 * 50_000
    extremes = np.array([-(1 << 63), -1, 0, (1 << 63) - 1])
    assert [c.tolist() for c in passages.unpacked(passages.packed(extremes, extremes[::-1]), 2)] == [extremes.tolist(), extremes[::-1].tolist()]
    assert [len(c) for c in passages.unpacked(passages.packed(seed[:0], doc[:0]), 2)] == [0, 0]


def test_corners_of_a_chain_align_alike():
    """A chain in order needs no tree, and its corners align as all its matches do."""
    rng = random.Random(3)
    for _ in range(20):
        words = rng.choices(range(40), k=400)
        x = np.array(words[:150] + rng.choices(range(40), k=rng.randint(0, 9)) + words[150:])
        at = [i for i in range(0, 140, rng.randint(1, 4))]
        matches = at + [i + len(x) - 400 for i in range(160, 380)], at + list(range(160, 380))
        (here, there), = [c for c in passages.chains(*map(np.array, matches)) if len(c[0]) > 100]
        assert (here.tolist(), there.tolist()) == matches
        few = passages._corners(here, there)
        assert len(few[0]) < len(here)
        for a, b in zip(passages.columns(x, np.array(words), *few), passages.columns(x, np.array(words), here, there)):
            assert (a == b).all()


def brute_words(texts):
    """Which words lie in 50 that an earlier text holds word by word."""
    seen, out = set(), []
    for t in texts:
        w = t.split()
        runs = [tuple(w[i : i + 50]) for i in range(len(w) - 49)]
        out.append({j for i, r in enumerate(runs) if r in seen for j in range(i, i + 50)})
        seen.update(runs)
    return out


def test_passages_whose_parts_are_first_elsewhere(spark):
    whole, line, more = prose(600, 80).split(), prose(601, 12), [prose(610 + k, 12) for k in range(6)]
    say = lambda k, x: f"{prose(700 + 2 * k, 70)} {x} {prose(701 + 2 * k, 70)}"
    parts = [" ".join(whole[:40]), " ".join(whole[40:]), " ".join(whole), " ".join(whole)]
    lines = [line] * 5 + more + [" ".join(more), line, " ".join(more), f"{line} {' '.join(more)}"]
    # in a source that holds parts of the passage before it, too
    lines += [" ".join(whole[10:50]) + " " + prose(690, 30) + " " + " ".join(whole[::-1]), " ".join(whole[::-1])]
    texts = [say(k, x) for k, x in enumerate(parts + lines)]
    found = passages.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    covered = [set() for _ in texts]
    for r in found:
        covered[r.doc_id].update(range(r.first_word, r.end_word))
    assert covered == brute_words(texts) and covered[3] == set(range(70, 150))


def brute_stretches(agree, at=0):
    score = lambda i, j: sum(1 if x else -4 for x in agree[i:j])
    best = max(((score(i, j), -j, i) for i in range(len(agree)) for j in range(i + 1, len(agree) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = best[2], -best[1]
    return [(at + i, at + j)] * (j - i >= 50) + brute_stretches(agree[:i], at) + brute_stretches(agree[j:], at + j)


def test_stretches_beside_a_short_best_one():
    edited = [k not in (12, 27, 42) for k in range(55)]
    chain = [True] * 45 + [False] * 15 + edited
    assert passages.stretches(np.array(chain)) == [(60, 115)]
    rng = random.Random(8)
    for _ in range(12):
        agree = [rng.random() < p for p in rng.choices((0.1, 0.9, 0.97, 1.0), k=3) for _ in range(rng.randint(10, 55))]
        assert sorted(passages.stretches(np.array(agree))) == sorted(brute_stretches(agree))
    words = prose(800, 115).split()
    copy = [w if x else f"e{k}" for k, (w, x) in enumerate(zip(words, chain))]
    x, y = (passages.word_hashes(" ".join(w)) for w in (copy, words))
    at = [k for k in range(112) if all(chain[k : k + 4])]
    assert passages.aligned(x, {"words": y.view(np.int64), "at": at, "src_at": at}) == [(60, 115, 60, 115, pytest.approx(52 / 55))]


def brute_repeats(texts):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for k, raw in enumerate(raws):
        for i in range(len(raw) - 399):
            seen.setdefault(raw[i : i + 400], []).append((k, i))
    gone = [bytearray(len(r)) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i : i + 400] = b"\1" * 400
    return [(len(r), sum(g), hashlib.sha256(bytes(b for b, x in zip(r, g) if not x)).hexdigest()) for r, g in zip(raws, gone)]


@pytest.mark.parametrize("chunk", [256, 3])
def test_suffixes_equal_brute_force(spark, none, chunk, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    base = prose(900, 260)
    texts = [base, base, prose(901, 90) + base[150:900], base[:700] + "é" + base[700:], base[300:702] + prose(902, 60), "ab" * 700, None, "", base[:399]]
    texts += [prose(910 + k, 10 + k) + base[200 + 3 * k : 660] + prose(930 + k, 12) for k in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.n_bytes, r.n_removed, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffixes.cut(docs).collect()}
    assert [rows[k] for k in range(len(texts))] == brute_repeats(texts)
    assert suffixes.cut(none).count() == 0


def test_suffixes_odd_rows(odd):
    rows = suffixes.cut(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc_id in (5, 6))


def test_merkle(odd, none):
    rows = merkle.with_next(odd.select("doc_id", "text")).collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(rows) == len(ODD)
    follow = {r.doc_id: r.next_text for r in rows}
    assert follow[14] == order[0][1] and follow[13] == "idiot loser scum" and follow[None] is None
    prints = {}
    for r in merkle.fingerprinted(odd).collect():
        prints.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values()) and len(set.union(*prints.values())) == len(prints)
    assert merkle.with_next(none.select("doc_id", "text")).count() == 0


def test_merkle_locates_edits(spark):
    a, b = "one\ntwo\n\nthree\nfour", "one\ntwo\n\nthree\nfive"
    df = merkle.fingerprinted(merkle.fingerprinted(spark.createDataFrame([(a, b)], "a string, b string"), "a", "a_"), "b", "b_")
    (row,) = df.select(merkle.differing(F.col("a_sections"), F.col("a_tree"), F.col("b_sections"), F.col("b_tree")).alias("d")).collect()
    assert [tuple(x) for x in row.d] == [(1, 1)]


def test_licenses(odd, none):
    rows = {r.doc_id: r for r in licenses.scanned(odd).collect()}
    assert len(licenses.rules()) > 200
    assert (rows[13].n_words, rows[13].n_base, rows[13].first_word, rows[13].last_word, rows[13].base_labels) == (7, 2, 2, 5, "apache,mit")
    assert rows[1].n_words == 0 and rows[1].labels == "" and rows[1].score == 0 and rows[1].first_word is None
    assert licenses.scanned(none).count() == 0


def test_license_rules_hold_their_keywords_and_priority(spark):
    text = "Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: BSD-3-Clause"
    (row,) = licenses.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.labels == "apache,apache-2.0,bsd-3-clause"  # the shorter names inside are suppressed
    assert [(d.first_word, d.label) for d in row.detections] == [(0, "apache-2.0"), (8, "bsd-3-clause")]


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(20):
        centre = rng.standard_normal(64)
        for _ in range(rng.integers(1, 12)):
            rows.append((centre + rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.35])).astype(np.float32))
    rows += [rows[0], rows[0], rows[0] * 3]
    data = [(k, [float(x) for x in v]) for k, v in enumerate(rows)]
    data += [(900, None), (901, [0.0] * 64), (902, [float("nan")] + [1.0] * 63), (903, [None] + [1.0] * 63), (904, [1.0, 2.0]), (905, [2.0, 4.0]), (None, [1.0, 2.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<float>")).collect()}
    x = np.stack(rows).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= 0.95
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([label[links[k]].min() for k in range(len(x))])
    assert all(found[k] == (links[k].sum() - 1, label[k]) for k in range(len(x)))
    assert all(found[k] == (0, k) for k in (900, 901, 902, 903)) and found[904] == (1, 904) and found[905] == (1, 904)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(empty).count() == 0


def test_vectors_of_several_lengths_and_grids(spark, monkeypatch):
    """Links do not depend on the grid, on chunks, or on other lengths in the table."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 24))
    near = np.concatenate([base + rng.normal(size=base.shape) * 0.1 * k for k in range(4)])
    odd = rng.normal(size=(20, 5))
    data = [(k, v.astype(np.float32).tolist()) for k, v in enumerate([*near, *odd, *(odd + 0.02)])]
    unit = [np.array(v) / np.linalg.norm(v) for _, v in data]
    links = {k: sum(len(u) == len(w) and j != k and float(u @ w) >= vectors.COSINE for j, w in enumerate(unit)) for k, u in enumerate(unit)}
    assert sum(links.values()) > 100
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    for grid, chunk in ((1, 16), (3, 8192)):
        monkeypatch.setattr(vectors, "grid_of", lambda n, g=grid: g)
        monkeypatch.setattr(vectors, "CHUNK", chunk)
        assert {r.vec_id: r.n_links for r in vectors.near_duplicates(table).collect()} == links


def test_grid_grows_with_the_table():
    assert [vectors.grid_of(n) for n in (0, 1000, 10**6, 10**7, 10**9)] == sorted(vectors.grid_of(n) for n in (0, 1000, 10**6, 10**7, 10**9))
    assert vectors.grid_of(1000) == 1 and vectors.grid_of(10**7) > 3


def test_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    rng = random.Random(3)
    for size in (1, 30, 400, 5000):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size + 4)]
        other = [w if rng.random() > 0.02 else "changed" for w in words]
        a, b = (minhash.shingles(" ".join(x)) for x in (words, other))
        bits = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(minhash.sketch(a), minhash.sketch(b)))
        assert bits <= np.setxor1d(a, b).size


def test_a_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """300 edited copies of one text, many of them no link of each other: only
    pairs that are about to link are looked at, and no link is lost."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for _ in range(300):
        words = list(base)
        for k in rng.sample(range(150), rng.choice([2, 3, 3, 4])):
            words[k] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = [set(minhash.shingles(t).tolist()) for t in texts]
    links = [(i, j) for i in range(300) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    root = list(range(300))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, j in links:
        x, y = find(i), find(j)
        root[max(x, y)] = min(x, y)
    looked_at, confirmed = [], minhash._confirmed
    monkeypatch.setattr(minhash, "_confirmed", lambda pairs, *a: looked_at.append(pairs.count()) or confirmed(pairs, *a))
    found = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {k: find(k) for k in range(300)}
    assert looked_at[-1] <= 3 * len(links) + 300 < 300 * 299 / 4
