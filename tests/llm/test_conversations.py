"""Chat layouts, repair and prefix trie: odd rows, brute force, registered SQL."""

import hashlib
import json
import random
import sys
import zlib
from functools import lru_cache

import duckdb
import pytest

from listweave.llm import chat, queries, repair, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def odd_turns():
    """Null values, blanks, repeated rows, control strings, a long conversation, copies."""
    rng = random.Random(8)
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", None), (1, None, "system", "Be kind."), (2, 0, None, "x"), (2, 0, None, "x"), (3, None, None, None), (4, 0, "user", " \t"), (5, 1, "assistant", "a\\1###\n</turn>####"), (5, 3, "us\ner:", "</turn></turn>\\"), (None, 0, "user", "Lost."), (None, 1, "assistant", "Found!")]
    rows += [(7, k, ("user", "assistant")[k % 2], f"Turn {k // 3}" + ".!? x"[k % 5]) for k in range(300)]
    for c in range(10, 90):
        rows += [(c, k, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["A.", "B.", "C", ""])) for k in range(rng.randint(0, 9))]
    rows += [(c, k, ("user", "assistant")[k % 2], f"same {k}.") for c in range(100, 160) for k in range(6)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def turns(spark):
    frame = spark.createDataFrame(odd_turns(), SCHEMA)
    clashing = ("record", "part", "layout", "formatted", "seen", "copy", "kind", "step", "edit", "path", "sizes", "mark", "parent", "family", "block", "ids", "_of")
    return frame.selectExpr("*", *[f"'?' AS {c}" for c in clashing])


@pytest.fixture(scope="module")
def sf_dir(turns, tmp_path_factory):
    """A folder whose table of conversations holds the odd rows."""
    path = tmp_path_factory.mktemp("sf")
    turns.repartition(3).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def by_turn(rows, null=""):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or null, r[3] or null)
    out = {}
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[1], r[2] if r[2] is not None else null, r[3] if r[3] is not None else null))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- chat layouts -----------------------------------------------------------


@pytest.mark.parametrize(("record", "layout", "turns"), [
    ({"messages": [{"role": "tool", "content": "a"}, {"role": None, "content": [{"type": "text", "text": "b"}, {"text": "c"}]}]}, "messages", [("tool", "a"), ("", "bc")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": 3}], "id": 4}, "from_value", [("user", "a"), ("assistant", "3")]),
    ({"dialog": {"turns": [{"speaker": {"role": "user"}, "utterance": {"text": None}}]}}, "utterances", [("user", "")]),
    ({"system": "s", "exchanges": [{"question": "q", "answer": "a"}]}, "exchanges", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c", "more": {"deep": [1]}}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "\ud800"}, "answer", [("user", "q"), ("assistant", "�")]),
    ({"messages": []}, None, None), ({"messages": {"role": "a", "content": "b"}}, None, None), ({}, None, None),
])
def test_layouts(record, layout, turns):
    assert chat.Reader(chat.LAYOUTS)(json.dumps(record))[1:] == (layout, turns)


def test_fingerprint_depends_on_paths_alone():
    read = chat.Reader(chat.LAYOUTS)
    first = read('{"messages": [{"role": "user", "content": "a"}], "n": 1}')[0]
    assert first == read('{"n": null, "messages": [{"content": "x", "role": "y"}, {"role": "z"}]}')[0]
    assert first != read('{"messages": [{"role": "user", "content": "a"}], "m": 1}')[0]
    assert read("[1]") == read("{") == read(None) == (None, None, None)


def test_template_is_reversible():
    rng, template = random.Random(5), chat.Template()
    say = lambda: "".join(rng.choices(["#", "###", "<", "</turn>", "\\", "\\1", "n", "\n", ":", "é", " "], k=rng.randint(0, 12)))
    for _ in range(2000):
        turns = [(rng.choice(["assistant", say()]), say()) for _ in range(rng.randint(0, 4))]
        text, mask = template.formatted(turns)
        assert list(template.turns(text)) == turns
        assert [template.unescaped(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
        assert all("###" not in template.escaped(t) and "</turn>" not in template.escaped(t) for _, t in turns)
    with pytest.raises(ValueError):
        chat.Template(closes="aba")


def test_records_in_tables(spark, none):
    rows = [(1, '{"prompt": "p", "completion": "c"}'), (1, '{"prompt": "p", "completion": "c"}'), (2, None), (3, "no json"), (4, '{"other": 1}')]
    records = spark.createDataFrame([(*r, "?") for r in rows], "id long, record string, layout string")
    found = chat.formatted(records, ["id"]).collect()
    assert [(r.id, r.layout) for r in sorted(found, key=lambda r: r.id)] == [(1, "prompt"), (1, "prompt"), (2, None), (3, None), (4, None)]
    assert all((r.formatted is None) == (r.layout is None) == (r.loss is None) for r in found)
    counts = {(r.layout, r.fingerprint is None): r.records for r in chat.layouts_found(records, ["id"]).collect()}
    assert counts == {("prompt", False): 2, (None, True): 2, (None, False): 1}
    assert chat.formatted(none.withColumnRenamed("text", "record"), ["doc_id"]).count() == 0


def test_chat_query_on_odd_turns(spark, sf_dir):
    want = by_turn([*odd_turns(), (-7, 0, "user", chat.TRIAL[2]), (-7, 1, "assistant", chat.TRIAL[2])])
    found = {r.conv_id: r for r in queries.op11_chat(spark, sf_dir).collect()}
    assert found.keys() == want.keys()
    for c, rows in want.items():
        learned = "".join(t for _, r, t in rows if r == "assistant")
        assert (found[c].n_turns, found[c].turns_sha256) == (len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)))
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(learned), sha(learned))
    parts = chat.formatted(chat.records_of(spark.read.parquet(f"{sf_dir}/conversations.parquet")), ["conv_id", "part"])
    layouts = {r.layout for r in parts.collect()}
    assert len(layouts) >= 5 and None not in layouts


# --- repair -------------------------------------------------------------------


def best(rows):
    """(cost, edits) of rows (initial, fault), least by cost, then as text."""
    fit, end, after = {"": "u", "s": "u", "u": "a", "a": "u"}, ("", "a"), {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    sys.setrecursionlimit(10_000)

    @lru_cache(None)
    def rest(i, last, inserts):
        ways = []
        if inserts < 3:
            cost, text = rest(i, fit[last], inserts + 1)
            ways.append((cost + 3, "I" + text))
        if i == len(rows):
            return min(ways + [(0, "")] * (last in end), default=(10**9, ""))
        initial, fault = rows[i]
        cost, text = rest(i + 1, last, 0)
        ways.append((cost + 4, "D" + text))
        if fault < 2:
            for edit, price, to in [("R", 3, fit[last])] + [("K", 0, initial)] * ((last, initial) in after):
                cost, text = rest(i + 1, to, 0)
                ways.append((cost + price + 3 * fault, edit + text))
        return min(ways)

    return rest(0, "", 0)


def test_edits_are_cheapest_and_least():
    rng = random.Random(2)
    for n in [0, 1, 2, 3, 4, 5, 8, 9, 10, 24, 25, 26, 60] * 40:
        rows = [(rng.choice("suat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        found = list(repair.edits(bytes(repair.coded(i, f) for i, f in rows)))
        cost, text = best(tuple(rows)) if n else (0, "")
        assert ("".join(e for e, *_ in found), sum(c for _, c, _ in found)) == (text, cost), rows


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if kind == 1 else "".join(ch for ch in x if ch not in ".!?") if kind == 2 else x
        out += [] if kind == 0 else [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def test_repair_query_on_odd_turns(spark, sf_dir):
    found = {r.conv_id: r for r in queries.op12_repair(spark, sf_dir).collect()}
    hurt = by_turn(damage(odd_turns()))
    assert found.keys() == {r[0] for r in odd_turns()}
    for c, row in found.items():
        rows, seen, coded = hurt.get(c, []), set(), []
        for _, role, text in rows:
            body = text.rstrip(" \t\n\v\f\r")
            coded.append((role[:1], 2 if not body else 3 if (role, text) in seen else int(body[-1] not in ".!?")))
            seen.add((role, text))
        counts = [sum(f == k for _, f in coded) for k in (2, 3, 1)]
        clocks = {t for t, *_ in rows if t is not None}
        gaps = max(clocks) - min(clocks) + 1 - len(clocks) if clocks else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        assert [row.gaps, row.blank, row.duplicate, row.truncated, row.illegal] == [gaps, *counts, illegal], c
        assert (row.cost, row.audit) == best(tuple(coded)) if coded else (row.cost, row.audit) == (0, "")
        if not rows:
            assert row.repaired_sha256 == sha("")


def test_repaired_rows_read_as_wanted(spark, turns):
    import re

    of = {}
    for r in repair.repaired(turns).collect():
        of.setdefault(r.conv_id, []).append(r)
    for rows in of.values():
        rows.sort(key=lambda r: r.step)
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r.role[:1] for r in rows if r.edit != "D"))
    assert repair.repaired(turns.limit(0)).count() == 0


# --- prefix trie -------------------------------------------------------------


def brute_nodes(rows):
    """Every node from every prefix of every conversation (id -> turns)."""
    members = {}
    for c, turns in rows.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = 1 if node not in kids else sum(leaves[k] for k in kids[node])
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids.get(node, []))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(rows[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids.get(node, [])), leaves[node], saved[node], sha(ends)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_turns", [1, 7, 40, 50_000])
def test_trie_equals_brute_force(spark, turns, shard_turns):
    own = {c: [(r, t) for _, r, t in rows] for c, rows in by_turn(odd_turns()).items() if c is not None}
    found = trie.trie(trie.paths_of(turns), shard_turns)
    assert sorted(map(tuple, found.collect()), key=str) == brute_nodes(own)


def test_trie_query_on_odd_turns(spark, sf_dir):
    own = {c: [(r, t) for _, r, t in rows] for c, rows in by_turn(odd_turns()).items() if c is not None}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    made = {c: own.get(c - c % 5, [])[: h[c]] + own[c][h[c] :] for c in own}
    assert sorted(map(tuple, queries.op13_trie(spark, sf_dir).collect()), key=str) == brute_nodes(made)


def test_trie_of_an_empty_table(spark, turns):
    assert trie.trie(trie.rebuilt(turns.limit(0))).count() == 0


def test_double_array_keeps_paths_apart():
    rng = random.Random(6)
    turn = lambda k: hashlib.md5(bytes([k % 256, k // 256])).digest()
    paths = sorted({b"".join(turn(rng.randint(0, 300)) for _ in range(rng.randint(0, 6))) for _ in range(3000)})
    made = trie.DoubleArray(paths)
    ends = {tuple(made.walk(ids))[-1] for ids in made.ids}
    assert len(ends) == len(paths) and len(made.order) == len({p[:k] for p in paths for k in range(0, len(p) + 1, 16)})
    assert len(made.check) < 3 * len(made.order)


@pytest.mark.parametrize("name", ["op11_chat", "op12_repair", "op13_trie"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet/*.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    found = queries.QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(str, map(tuple, found.select(*names).collect()))) == sorted(map(str, want.fetchall()))
