"""Repair of the structure of conversations by cheapest edits.

Rows of a conversation are kept, reroled or deleted, and turns without text
inserted, so that the roles read ``(s?(ua)+)?`` by their initials. Costs of the
rest of a conversation by state are a vector of four numbers; going backward
they are stored at every sqrt(n)-th row only, and each block is worked out
again from its checkpoint while walking forward, where of the edits that lose
nothing the ASCII-least is taken. A conversation of n rows holds n bytes and
about 2 sqrt(n) vectors; its texts wait in a spool on the disk.

Defined results: a null role or text is empty; a conversation comes in the
order of its turns (null first; ties by role, then text), a null ``conv_id`` is
a conversation of its own; equal rows are duplicates; an empty table gives an
empty one; other columns are not read, whatever their names."""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from itertools import groupby
from math import isqrt
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import streamed

#: What edits cost. A truncated row that stays costs as much again.
COST = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED = 3
BLANKS = " \t\n\v\f\r"
NEVER = 1 << 60

# States by the last role: nothing yet, system, user, assistant.
_AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The state that a turn of the one role that fits leads to, and that role.
_FIT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
#: What is left to insert at the end.
_END = (0, 2 * COST["I"], COST["I"], 0)

FAULTS = (None, "truncated", "blank", "duplicate")


def _moves(initial: str, fault: int) -> list[list[tuple[str, int, int]]]:
    """By state, the edits of a row but for insertions: (name, cost, state)."""
    moves = []
    for state in range(4):
        own = [("D", COST["D"], state)]
        if fault < 2:
            stays = TRUNCATED * fault
            after = _AFTER.get(initial, (None,) * 4)[state]
            if after is not None:
                own.append(("K", stays, after))
            own.append(("R", COST["R"] + stays, _FIT[state]))
        moves.append(own)
    return moves


_INITIALS = ("s", "u", "a", "")
#: By the code of a row: 4 * initial + fault.
_MOVES = [_moves(i, f) for i in _INITIALS for f in range(4)]


def coded(role: str, fault: int) -> int:
    return 4 * (_INITIALS.index(role[:1]) if role[:1] in ("s", "u", "a") else 3) + fault


def _back(code: int, after: tuple) -> tuple:
    """Costs from before a row on, from those after it."""
    plain = [min(cost + after[to] for _, cost, to in own) for own in _MOVES[code]]
    once = [min(plain[s], COST["I"] + plain[_FIT[s]]) for s in range(4)]
    return tuple(min(once[s], COST["I"] + once[_FIT[s]]) for s in range(4))


def edits(codes: bytes) -> Iterator[tuple[str, int, int]]:
    """(edit, its cost, state before it) of the cheapest repair of the rows with
    these codes, of equal ones the ASCII-least. Every edit but I takes a row."""
    n = len(codes)
    step = max(isqrt(n), 1)
    checkpoints, costs = [], _END
    for i in range(n, 0, -1):
        if i % step == 0 or i == n:
            checkpoints.append(costs)
        costs = _back(codes[i - 1], costs)
    state = 0
    for start in range(0, n, step):
        stop = min(start + step, n)
        block = [checkpoints.pop()]
        for i in range(stop - 1, start - 1, -1):
            block.append(_back(codes[i], block[-1]))
        block.reverse()
        for i in range(start, stop):
            here, after, row = block[i - start], block[i - start + 1], _MOVES[codes[i]]
            while True:
                ways = [("I", COST["I"], _FIT[state])] + row[state]
                tight = [w for w in ways if w[1] + (here if w[0] == "I" else after)[w[2]] == here[state]]
                edit, cost, to = min(tight)
                yield edit, cost, state
                state = to
                if edit != "I":
                    break
    while _END[state]:
        yield "I", COST["I"], state
        state = _FIT[state]


def _fault(text: str, seen: bool) -> int:
    body = text.rstrip(BLANKS)
    if not body:
        return 2
    return 3 if seen else int(body[-1] not in ".!?")


def repaired(turns: DataFrame) -> DataFrame:
    """The edits of each conversation of ``turns`` (conv_id, turn, role, text) in
    their order, one row each: conv_id, step, edit (D, I, K, R), cost, fault of
    the row (blank, duplicate, truncated or null), its turn and role as it was,
    and role and text as they are after it (of a deleted row as they were)."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).repartition("conv_id")
    # both windows and sorts keep the one partitioning by conversation
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn")) > 1
    ordered = rows.withColumn("seen", seen).sortWithinPartitions("conv_id", "turn", "role", "text", "seen")

    def repair(rows):
        for conv_id, those in groupby(rows, itemgetter(0)):
            with tempfile.SpooledTemporaryFile(max_size=1 << 22) as spool:
                codes = bytearray()
                for _, turn, role, text, again in those:
                    codes.append(coded(role, _fault(text, again)))
                    pickle.dump((turn, role, text), spool)
                spool.seek(0)
                at = 0
                for step, (edit, cost, state) in enumerate(edits(bytes(codes))):
                    if edit == "I":
                        yield conv_id, step, edit, cost, None, None, None, _ROLE[state], ""
                        continue
                    turn, role, text = pickle.load(spool)
                    yield conv_id, step, edit, cost, FAULTS[codes[at] % 4], turn, role, _ROLE[state] if edit == "R" else role, text
                    at += 1

    kinds = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kinds['conv_id']}, step bigint, edit string, cost bigint, fault string, turn {kinds['turn']}, was_role string, role string, text string"
    return streamed(ordered, repair, schema)


def conversations(steps: DataFrame) -> DataFrame:
    """One row per conversation from the rows of ``repaired``, which follow each
    other there: counts of faults, gaps and illegal neighbours before the repair,
    its cost, its edits and the hash of what it leaves."""

    def digest(rows):
        for conv_id, those in groupby(rows, itemgetter(0)):
            counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
            illegal = cost = distinct = 0
            least = last = before = None
            audit, left, first = [], hashlib.sha256(), True
            for _, edit, price, fault, turn, was, role, text in those:
                audit.append(edit)
                cost += price
                if edit != "I":
                    if fault:
                        counts[fault] += 1
                    if before is not None and before + was[:1] not in ("su", "ua", "au"):
                        illegal += 1
                    before = was[:1]
                    if turn is not None and turn != last:
                        least, last, distinct = turn if least is None else least, turn, distinct + 1
                if edit != "D":
                    left.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            gaps = 0 if last is None else last - least + 1 - distinct
            yield conv_id, gaps, *counts.values(), illegal, cost, "".join(audit), left.hexdigest()

    kind = steps.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return streamed(steps.select("conv_id", "edit", "cost", "fault", "turn", "was_role", "role", "text"), digest, schema)


def damage_kind(conv_id: Column, turn: Column) -> Column:
    text = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    return F.crc32(F.concat(text(conv_id), F.lit(":"), text(turn))) % 20


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults: a row in twenty each is dropped, emptied, robbed of
    its sentence ends, repeated or given to the user."""
    rows = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    kind = F.col("kind")
    rows = rows.withColumn("kind", damage_kind(F.col("conv_id"), F.col("turn"))).filter(kind != 0)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


_CRC = "xor(list_reduce([4294967295::BIGINT] || [ord(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')], lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"
# a conversation without id is one of its own; here a number stands for it, so that joins find it
_NO_ID = "-9223372036854775807"
_ID = f"coalesce(conv_id, {_NO_ID})"
_LAST = "rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
#: The costs `v` of the rest by state (1 to 4: nothing yet, s, u, a) before a row, from those after it.
_PLAIN = """least(4 + v[1], pen + 3 + v[3], CASE ini WHEN 's' THEN pen + v[2] WHEN 'u' THEN pen + v[3] END), least(4 + v[2], pen + 3 + v[3], CASE WHEN ini = 'u' THEN pen + v[3] END),
  least(4 + v[3], pen + 3 + v[4], CASE WHEN ini = 'a' THEN pen + v[4] END), least(4 + v[4], pen + 3 + v[3], CASE WHEN ini = 'u' THEN pen + v[3] END)"""
#: DuckDB: costs backward row by row, then the walk forward, edit by edit.
ORACLE = f"""
WITH RECURSIVE hurt AS (SELECT {_ID} AS conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS k FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) FROM hurt WHERE k <> 0)),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
r AS MATERIALIZED (SELECT *, left(role, 1) AS ini, CASE WHEN {_LAST} = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN NOT regexp_matches({_LAST}, '[.!?]$') THEN 'truncated' END AS fault FROM placed),
q AS MATERIALIZED (SELECT *, CASE fault WHEN 'truncated' THEN 3 WHEN 'blank' THEN NULL WHEN 'duplicate' THEN NULL ELSE 0 END AS pen FROM r),
size AS (SELECT conv_id, max(i) AS n FROM r GROUP BY conv_id),
back(conv_id, i, v) AS (SELECT conv_id, n + 1, [0, 6, 3, 0]::BIGINT[] FROM size
  UNION ALL SELECT conv_id, i, [least(p[1], 3 + p[3], 6 + p[4]), least(p[2], 3 + p[3], 6 + p[4]), least(p[3], 3 + p[4]), least(p[4], 3 + p[3])] FROM (
    SELECT q.conv_id, q.i, [{_PLAIN}] AS p FROM back b JOIN q ON q.conv_id = b.conv_id AND q.i = b.i - 1)),
costs AS MATERIALIZED (SELECT b.conv_id, b.i, b.v, a.v AS w, q.ini, q.pen, q.role, q.text FROM back b LEFT JOIN back a ON a.conv_id = b.conv_id AND a.i = b.i + 1 LEFT JOIN q ON q.conv_id = b.conv_id AND q.i = b.i),
walk(conv_id, i, s, audit, left_) AS (SELECT conv_id, 1::BIGINT, 1, '', []::VARCHAR[] FROM size
  UNION ALL SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN s WHEN 'K' THEN go ELSE fit END, audit || e,
    CASE e WHEN 'D' THEN left_ WHEN 'I' THEN left_ || [fits || ':'] WHEN 'K' THEN left_ || [role || ':' || text] ELSE left_ || [fits || ':' || text] END FROM (
    SELECT *, CASE WHEN 4 + w[s] = v[s] THEN 'D' WHEN 3 + v[fit] = v[s] THEN 'I' WHEN pen + w[go] = v[s] THEN 'K' ELSE 'R' END AS e FROM (
      SELECT x.*, c.v, c.w, c.pen, c.role, c.text, [3, 3, 4, 3][s] AS fit, ['user', 'user', 'assistant', 'user'][s] AS fits,
        CASE WHEN ini = 's' AND s = 1 THEN 2 WHEN ini = 'u' AND s <> 3 THEN 3 WHEN ini = 'a' AND s = 3 THEN 4 END AS go
      FROM walk x JOIN costs c ON c.conv_id = x.conv_id AND c.i = x.i WHERE c.w IS NOT NULL OR s IN (2, 3)))),
final AS (SELECT conv_id, arg_max(audit, length(audit)) AS audit, sha256(array_to_string(arg_max(left_, length(audit)), chr(10))) AS repaired_sha256 FROM walk GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM r) GROUP BY conv_id)
SELECT nullif(a.conv_id, {_NO_ID}) AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(b.v[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT {_ID} AS conv_id FROM conversations) a LEFT JOIN counts USING (conv_id) LEFT JOIN final USING (conv_id) LEFT JOIN back b ON b.conv_id = a.conv_id AND b.i = 1"""
